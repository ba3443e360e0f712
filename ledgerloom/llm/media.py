"""Telephony audio: mu-law and A-law by lookup tables, IMA ADPCM blocks decoded across blocks, PCM resampled and stored.

G.711 samples expand through 256-entry tables. ADPCM is sequential within a block but blocks are independent, so the
decoder steps through a block's nibbles once, for all blocks of a batch together, in numpy. Audio is stored as WAV:
G.711 bytes as they are (lossless), PCM as 16-bit samples.

store_texts() writes the padded payloads as mu-law samples in WAV files, a binary column of a table in the shared folder.
with_pcm() reads that column back and adds the 16 kHz 16-bit PCM as another binary column, to be stored in turn. digests()
takes sizes, hashes and features from what is stored: levels of the mu-law, A-law and ADPCM readings, and the check sum of
the PCM, which it makes from the WAV files where there is no such column.

Defined cases: a null text is the empty payload, padded to one unit; rows are independent, so repeated rows give equal
values and extra columns change nothing; long texts are decoded `TOGETHER` bytes at a time; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_batches, stored


#: Bytes of an ADPCM block and unit of the padded payload; rate of telephony audio, and of the stored PCM.
UNIT, RATE, STORED_RATE = 576, 8000, 16000
PAD = b"\xff"
PCM, ALAW, MULAW = 1, 6, 7
#: Bytes of payload that are decoded together, a multiple of UNIT, and bytes of an Arrow batch.
TOGETHER, BATCH = UNIT << 11, 8 << 20

# Index steps of IMA ADPCM by the low three bits of a nibble.
INDEX_STEPS = (-1, -1, -1, -1, 2, 4, 6, 8)

MEDIA = "doc_id long, n_bytes long, media binary"
ROW = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


@lru_cache(maxsize=1)
def mulaw_table() -> np.ndarray:
    """16-bit value of each mu-law byte."""
    u = ~np.arange(256, dtype=np.int64) & 0xFF
    size = ((((u & 0x0F) << 3) + 0x84) << ((u >> 4) & 7)) - 0x84
    return np.where(u & 0x80, -size, size).astype(np.int16)


@lru_cache(maxsize=1)
def alaw_table() -> np.ndarray:
    """16-bit value of each A-law byte."""
    a = np.arange(256, dtype=np.int64) ^ 0x55
    segment, low = (a >> 4) & 7, ((a & 0x0F) << 4) + 8
    size = np.where(segment == 0, low, (low + 0x100) << np.maximum(segment - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    # The quantiser steps of IMA ADPCM.
    return np.array(
        [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
        dtype=np.int32,
    )


def adpcm_blocks(blocks: np.ndarray) -> np.ndarray:
    """16-bit samples (blocks, samples) of mono IMA ADPCM blocks (blocks, bytes): a 4-byte header, then nibbles, low first."""
    steps, moves = _steps(), np.array(INDEX_STEPS, dtype=np.int32)
    head = blocks[:, :2].astype(np.int32)
    value = head[:, 0] | (head[:, 1] << 8)
    value = np.where(value >= 1 << 15, value - (1 << 16), value)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(steps) - 1)
    data = np.ascontiguousarray(blocks[:, 4:].T)
    out = np.empty((1 + 2 * len(data), len(blocks)), dtype=np.int16)
    out[0] = value
    for k, byte in enumerate(data):
        for j, nibble in ((1, byte & 15), (2, byte >> 4)):
            code = nibble.astype(np.int32)
            size, step = code & 7, steps[index]
            change = ((2 * size + 1) * step) >> 3
            value = np.clip(np.where(code & 8, value - change, value + change), -(1 << 15), (1 << 15) - 1)
            index = np.clip(index + moves[size], 0, len(steps) - 1)
            out[2 * k + j] = value
    return out.T


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation of 16-bit samples; whole ratios only."""
    if to % rate:
        raise ValueError(f"{to} is no multiple of {rate}")
    k, x = to // rate, pcm.astype(np.int32)
    if not len(x):
        return pcm
    after = np.append(x[1:], x[-1:])
    return np.stack([(x * (k - j) + after * j) // k for j in range(k)], axis=1).reshape(-1).astype(np.int16)


def wav(data: bytes, kind: int, rate: int) -> bytes:
    """A mono WAV file: 8-bit G.711 or 16-bit PCM samples."""
    width = 2 if kind == PCM else 1
    body = b"fmt " + struct.pack("<IHHIIHHH", 18, kind, 1, rate, rate * width, width, 8 * width, 0)
    body += b"fact" + struct.pack("<II", 4, len(data) // width) + b"data" + struct.pack("<I", len(data)) + data + bytes(len(data) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def read_wav(stored: bytes) -> tuple[int, int, bytes]:
    """Kind, rate and sample bytes of a WAV file."""
    if stored[:4] != b"RIFF" or stored[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, kind, rate = 12, None, None
    while at + 8 <= len(stored):
        name, size = stored[at : at + 4], struct.unpack_from("<I", stored, at + 4)[0]
        if name == b"fmt ":
            kind, _, rate = struct.unpack_from("<HHI", stored, at + 8)
        elif name == b"data":
            return kind, rate, stored[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def samples(kind: int, data: bytes) -> np.ndarray:
    """16-bit samples of G.711 or PCM bytes."""
    if kind == PCM:
        return np.frombuffer(data, dtype="<i2")
    return (mulaw_table() if kind == MULAW else alaw_table())[np.frombuffer(data, dtype=np.uint8)]


def decode(stored: bytes) -> tuple[int, np.ndarray]:
    """Rate and 16-bit samples of a WAV file of G.711 or PCM."""
    kind, rate, data = read_wav(stored)
    return rate, samples(kind, data)


def to_pcm(stored: bytes, rate: int = STORED_RATE) -> bytes:
    """The file as 16-bit PCM WAV at another rate, a part of the samples at a time."""
    kind, now, data = read_wav(stored)
    width = 2 if kind == PCM else 1
    out, step = [], TOGETHER * width
    for at in range(0, len(data), step):
        pcm = samples(kind, data[at : at + step + width])  # one more, towards which the last one is drawn
        part = resample(pcm, now, rate)
        out.append((part[: len(part) - rate // now] if at + step < len(data) else part).astype("<i2").tobytes())
    return wav(b"".join(out), PCM, rate)


class _Level:
    """Peak and mean square of samples that come in parts."""

    def __init__(self) -> None:
        self.peak, self.squares, self.n = 0, 0, 0

    def add(self, x: np.ndarray) -> None:
        x = x.astype(np.int64)
        self.peak, self.squares, self.n = max(self.peak, int(np.abs(x).max())), self.squares + int((x * x).sum()), self.n + len(x)

    def __str__(self) -> str:
        return f"{self.peak}/{self.squares // self.n}"


def features(payloads: list[bytes], pcms: Iterable[bytes]) -> list[str]:
    """A line of levels (peak/mean square) for each payload, each a multiple of UNIT, and the check sum of its PCM samples.

    ADPCM blocks of several payloads are decoded together, and those of a long payload in parts.
    """
    levels = [(_Level(), _Level(), _Level()) for _ in payloads]
    held: list[tuple[int, bytes]] = []
    size = 0

    def work() -> None:
        whole = np.frombuffer(b"".join(p for _, p in held), dtype=np.uint8)
        ima, at = adpcm_blocks(whole.reshape(-1, UNIT)), 0
        for k, p in held:
            raw = whole[at * UNIT : at * UNIT + len(p)]
            for level, x in zip(levels[k], (mulaw_table()[raw], alaw_table()[raw], ima[at : at + len(p) // UNIT].reshape(-1)), strict=True):
                level.add(x)
            at += len(p) // UNIT
        held.clear()

    for k, p in enumerate(payloads):
        for at in range(0, len(p), TOGETHER):
            held.append((k, p[at : at + TOGETHER]))
            size += len(held[-1][1])
            if size >= TOGETHER:
                work()
                size = 0
    if held:
        work()
    return [f"mulaw={mu} alaw={a} adpcm={ima} pcm{STORED_RATE}={zlib.crc32(pcm):08x}" for (mu, a, ima), pcm in zip(levels, pcms, strict=True)]


def _media(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n_bytes, media = [], []
        for text in b.column("text").to_pylist():
            raw = (text or "").encode()
            n_bytes.append(len(raw))
            media.append(wav(raw + PAD * (-len(raw) % UNIT or (0 if raw else UNIT)), MULAW, RATE))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def _pcm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        media, first, size = b.column("media"), 0, 0
        for k in range(len(media)):  # a few MB at a time, as the PCM is four times as long
            size += len(media[k].as_buffer())
            if size >= BATCH // 4 or k == len(media) - 1:
                part = b.slice(first, k + 1 - first)
                pcm = pa.array([to_pcm(m) for m in part.column("media").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, pcm], names=[*b.schema.names, "pcm"])
                first, size = k + 1, 0


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in ROW.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in ROW.split(", ")]
    for b in batches:
        media = b.column("media").to_pylist()
        back = [read_wav(m)[2] for m in media]
        pcm = (read_wav(x)[2] for x in (b.column("pcm").to_pylist() if "pcm" in b.schema.names else map(to_pcm, media)))
        sha = lambda x: hashlib.sha256(x).hexdigest()
        columns = [
            b.column("doc_id"), b.column("n_bytes"), [len(p) for p in back], [sha(p) for p in back], [zlib.crc32(p[-32:]) for p in back],
            [len(m) for m in media], [sha(m) for m in media], features(back, pcm),
        ]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the text) and media (a mu-law WAV file) of every text, written to the shared folder."""
    with arrow_batches(docs.sparkSession, 1024, BATCH):
        return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_media, MEDIA))


def with_pcm(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media of store_texts(), and pcm, a 16-bit WAV file at STORED_RATE. Writing it takes four bytes a sample."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_pcm, MEDIA + ", pcm binary")


def digests(audio: DataFrame) -> DataFrame:
    """doc_id, sizes, hashes and features of store_texts()'s or with_pcm()'s rows; a stored table, made a few MB at a time."""
    some = audio.select("doc_id", "n_bytes", "media", *(["pcm"] if "pcm" in audio.columns else []))
    with arrow_batches(audio.sparkSession, 1024, BATCH):
        return stored(some.mapInArrow(_digests, ROW))
