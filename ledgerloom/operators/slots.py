"""Places for models that do not ship: OCR engines, model extractors, verifiers, preprocessing, corruption, rendering.

A slot is a function on pandas batches. run() gives each engine's rows with an error column instead of failing, and
only the rows that pass a filter reach Python. The stubs are deterministic and read nothing but text.
"""

from __future__ import annotations

import json
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, wait

import pandas as pd
from pyspark.sql import DataFrame

ENGINE_ROWS = "doc_id string, engine string, raw_text string, error string"
Engine = Callable[[pd.Series], pd.Series]


def run(docs: DataFrame, engines: dict[str, Engine]) -> DataFrame:
    """(doc_id, engine, raw_text, error) of every engine over docs (doc_id, content)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, engine in engines.items():
                out = pd.DataFrame({"doc_id": b["doc_id"].astype(str), "engine": name, "raw_text": None, "error": None})
                try:
                    out["raw_text"] = engine(b["content"]).to_numpy()
                except Exception as e:  # an engine's failure is a row's result
                    out["error"] = f"{type(e).__name__}: {e}"
                yield out

    return docs.select("doc_id", "content").mapInPandas(each, ENGINE_ROWS)


def first_available(verifiers: list[tuple[str, Callable[[], bool]]]) -> str | None:
    """The first verifier that says it can work."""
    return next((name for name, ready in verifiers if ready()), None)


ANSWER_ROWS = "doc_id string, answer string, tries int, error string"
VERDICT_ROWS = "doc_id string, field_id string, verdict string, verifier double, reason string"
#: Calls of a task that run at a time, and seconds after which a call is given up.
FLIGHT, SECONDS = 8, 180.0
#: Calls that may wait for an earlier one, as results are given in order, for each that runs.
AHEAD = 4


def in_flight(items: Iterable, call: Callable, flight: int = FLIGHT, seconds: float = SECONDS) -> Iterator:
    """What the call gives for each item, or the error it ends in, in the items' order; `flight` calls run at a time.

    A call that takes longer than `seconds` is a TimeoutError. Its thread cannot be stopped: it is left behind, and its place is free.
    """
    todo, window, running, late = iter(items), deque(), {}, set()
    more = True
    while window or more:
        while more and len(running) < flight and len(window) < AHEAD * flight:
            try:
                item = next(todo)
            except StopIteration:
                more = False
                break
            f: Future = Future()
            window.append(f)
            running[f] = time.monotonic()
            threading.Thread(target=_fill, args=(f, call, item), daemon=True).start()
        while window and window[0] not in running:
            f = window.popleft()
            yield TimeoutError(f"no answer in {seconds:g} s") if f in late else f.exception() or f.result()
        if running:
            done, _ = wait(running, max(0.0, min(running.values()) + seconds - time.monotonic()), FIRST_COMPLETED)
            over = [f for f, began in running.items() if f not in done and time.monotonic() - began >= seconds]
            late.update(over)
            for f in (*done, *over):
                del running[f]


def _fill(f: Future, call: Callable, item: object) -> None:
    try:
        f.set_result(call(item))
    except Exception as e:  # noqa: BLE001  a call's failure is its result
        f.set_exception(e)


def _said(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def json_object(answer: str) -> str | None:
    """What is wrong with an answer that should be a JSON object, or None."""
    try:
        return None if isinstance(json.loads(answer), dict) else "no object"
    except (TypeError, ValueError) as e:
        return _said(e)


# The fields of a typed answer, those that are text and those that are amounts, each with a confidence.
TEXTS, AMOUNTS = ("vendor", "date"), ("total", "vat")


def typed_fields(answer: str) -> str | None:
    """What is wrong with an answer that should hold the typed fields: texts, amounts from 0, confidences from 0 to 1; each may be missing or null."""
    if wrong := json_object(answer):
        return wrong
    given, wrong = json.loads(answer), []
    number = lambda v: isinstance(v, int | float) and not isinstance(v, bool)
    for f in (*TEXTS, *AMOUNTS):
        v, sure = given.get(f), given.get(f"{f}_confidence")
        if v is not None and not (isinstance(v, str) if f in TEXTS else number(v) and v >= 0):
            wrong.append(f"{f} is no {'text' if f in TEXTS else 'amount'}")
        if sure is not None and not (number(sure) and 0 <= sure <= 1):
            wrong.append(f"{f}_confidence is not from 0 to 1")
    return "; ".join(wrong) or None


def ask(docs: DataFrame, model: Callable[[str, str | None], str], retries: int = 2, check: Callable[[str], str | None] = json_object, flight: int = FLIGHT, seconds: float = SECONDS) -> DataFrame:
    """(doc_id, answer, tries, error) of a model extractor over docs (doc_id, text).

    model is called with the text and what was wrong with its last answer, None at first; check tells what is wrong. A call that fails
    or takes too long counts as a try. `flight` calls of a task run at a time; rows stay in order.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = [(str(d), None, 0, None) for d in b["doc_id"]]
            texts, open_ = list(b["text"]), list(range(len(rows)))
            for k in range(1, retries + 2):
                left = []
                for i, answer in zip(open_, in_flight(((texts[i], rows[i][3]) for i in open_), lambda x: model(*x), flight, seconds), strict=True):
                    wrong = _said(answer) if isinstance(answer, Exception) else check(answer)
                    rows[i] = (rows[i][0], None if wrong else answer, k, wrong)
                    if wrong:
                        left.append(i)
                open_ = left
            yield pd.DataFrame(rows, columns=["doc_id", "answer", "tries", "error"])

    return docs.select("doc_id", "text").mapInPandas(each, ANSWER_ROWS)


def verify(fields: DataFrame, verifiers: list[tuple[str, Callable[[], bool], Callable[[str, str, str], tuple[str, float, str]]]], flight: int = FLIGHT, seconds: float = SECONDS) -> DataFrame:
    """(doc_id, field_id, verdict, verifier, reason) of the first available verifier over fields (doc_id, field_id, value, text).

    A verifier (name, whether it can work, function of field, value and text) that fails or takes too long flags the field with
    confidence 0, as all are if none is available. `flight` calls of a task run at a time; rows stay in order.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = first_available([v[:2] for v in verifiers])
        check = next((f for n, _, f in verifiers if n == name), None)

        def call(x: tuple) -> tuple[str, float, str]:
            if check is None:
                raise Unavailable("no verifier is available")
            verdict, confidence, reason = check(*x)
            return verdict, float(confidence), reason

        for b in batches:
            asked = zip(b["field_id"], b["value"], b["text"], strict=True)
            said = [("flag", 0.0, _said(x)) if isinstance(x, Exception) else x for x in in_flight(asked, call, flight, seconds)]
            rows = [(str(d), f, *x) for d, f, x in zip(b["doc_id"], b["field_id"], said, strict=True)]
            yield pd.DataFrame(rows, columns=["doc_id", "field_id", "verdict", "verifier", "reason"])

    return fields.select("doc_id", "field_id", "value", "text").mapInPandas(each, VERDICT_ROWS)


def text_engine(content: pd.Series) -> pd.Series:
    """Stub engine: bytes as UTF-8 text."""
    return content.map(lambda x: x.decode("utf-8", "replace") if isinstance(x, (bytes, bytearray)) else x)


class Unavailable(RuntimeError):
    """A slot's library or model is not here."""


CONTENT_ROWS = "doc_id string, content binary, note string, error string"
#: A step on one document: bytes and a parameter in, bytes and a note out.
Step = Callable[[bytes, str], tuple[bytes, str]]


def run_step(docs: DataFrame, step: Step) -> DataFrame:
    """(doc_id, content, note, error) of a step over docs (doc_id, content, parameter). A failure is a row with an error and no content."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, content, parameter in zip(b["doc_id"], b["content"], b["parameter"], strict=True):
                try:
                    rows.append((str(doc_id), *step(content, parameter), None))
                except Exception as e:  # as above
                    rows.append((str(doc_id), None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "content", "note", "error"])

    return docs.select("doc_id", "content", "parameter").mapInPandas(each, CONTENT_ROWS)


def _imaging():
    try:
        import cv2
    except ImportError as e:
        raise Unavailable("no image library is installed") from e
    return cv2


# A page is enlarged below this side, by this factor; skew that is undone, in degrees; block and offset of the
# adaptive threshold.
SMALL_SIDE, ENLARGE, SKEW, THRESHOLD = 2000, 3.5, (0.5, 15.0), (31, 10)


def preprocess(content: bytes, parameter: str) -> tuple[bytes, str]:
    """A page image for an OCR engine: grey, enlarged if small, straightened, black and white. Needs OpenCV."""
    cv2 = _imaging()
    import numpy as np

    page = cv2.imdecode(np.frombuffer(content, np.uint8), cv2.IMREAD_GRAYSCALE)
    if page is None:
        raise ValueError("no image")
    if max(page.shape) < SMALL_SIDE:
        page = cv2.resize(page, None, fx=ENLARGE, fy=ENLARGE, interpolation=cv2.INTER_LANCZOS4)
    ink = cv2.findNonZero(255 - page)
    angle = 0.0 if ink is None else cv2.minAreaRect(ink)[-1]
    angle = angle - 90 if angle > 45 else angle
    if SKEW[0] <= abs(angle) <= SKEW[1]:
        high, wide = page.shape
        page = cv2.warpAffine(page, cv2.getRotationMatrix2D((wide / 2, high / 2), angle, 1.0), (wide, high), borderValue=255)
    page = cv2.adaptiveThreshold(page, 255, cv2.ADAPTIVE_THRESH_GAUSSIAN_C, cv2.THRESH_BINARY, *THRESHOLD)
    return cv2.imencode(".png", page)[1].tobytes(), f"{angle:.1f}"


def corrupt(content: bytes, bucket: str) -> tuple[bytes, str]:
    """A page image as a bucket's scan would have it; clean pages pass as they are. Others need OpenCV, and come rotated and compressed only."""
    # By bucket, degrees of rotation at most and JPEG quality from and to.
    turns = {"light": (2, 80, 92), "heavy": (8, 35, 60), "very-heavy": (90, 30, 50)}
    if bucket == "clean":
        return content, "unchanged"
    if bucket not in turns:
        raise ValueError(f"no such bucket: {bucket}")
    cv2 = _imaging()
    import random
    import zlib

    import numpy as np

    most, low, high = turns[bucket]
    draw = random.Random(zlib.crc32(content))
    page = cv2.imdecode(np.frombuffer(content, np.uint8), cv2.IMREAD_COLOR)
    if page is None:
        raise ValueError("no image")
    tall, wide = page.shape[:2]
    angle, quality = draw.uniform(-most, most), draw.randint(low, high)
    page = cv2.warpAffine(page, cv2.getRotationMatrix2D((wide / 2, tall / 2), angle, 1.0), (wide, tall), borderValue=(255, 255, 255))
    return cv2.imencode(".jpg", page, [cv2.IMWRITE_JPEG_QUALITY, quality])[1].tobytes(), f"rotated {angle:.1f}, quality {quality}"


def render(content: bytes, style: str) -> tuple[bytes, str]:
    """HTML as PDF. Needs WeasyPrint."""
    try:
        import weasyprint
    except ImportError as e:
        raise Unavailable("no PDF renderer is installed") from e
    return weasyprint.HTML(string=content.decode()).write_pdf(stylesheets=[weasyprint.CSS(string=style)] if style else None), f"weasyprint {weasyprint.__version__}"


def page_to_pdf(content: bytes, parameter: str) -> tuple[bytes, str]:
    """A JPEG page as a PDF of one page, which shows it as it is; parameter: dots an inch."""
    at, size = 2, None
    while size is None:
        if content[at : at + 1] != b"\xff" or at + 9 > len(content):
            raise ValueError("no JPEG")
        kind, length = content[at + 1], int.from_bytes(content[at + 2 : at + 4], "big")
        if 0xC0 <= kind <= 0xC3:
            size = int.from_bytes(content[at + 7 : at + 9], "big"), int.from_bytes(content[at + 5 : at + 7], "big")
            grey = content[at + 9] == 1
        at += 2 + length
    wide, tall = (72 * x / float(parameter or 300) for x in size)
    draws = f"q {wide:.2f} 0 0 {tall:.2f} 0 0 cm /I Do Q".encode()
    parts = [
        b"<</Type/Catalog/Pages 2 0 R>>", b"<</Type/Pages/Kids[3 0 R]/Count 1>>",
        f"<</Type/Page/Parent 2 0 R/MediaBox[0 0 {wide:.2f} {tall:.2f}]/Resources<</XObject<</I 4 0 R>>>>/Contents 5 0 R>>".encode(),
        f"<</Type/XObject/Subtype/Image/Width {size[0]}/Height {size[1]}/ColorSpace/Device{'Gray' if grey else 'RGB'}/BitsPerComponent 8/Filter/DCTDecode/Length {len(content)}>>stream\n".encode() + content + b"\nendstream",
        f"<</Length {len(draws)}>>stream\n".encode() + draws + b"\nendstream",
    ]
    out, places = b"%PDF-1.4\n", []
    for i, part in enumerate(parts, 1):
        places.append(len(out))
        out += f"{i} 0 obj".encode() + part + b"endobj\n"
    table = "".join(f"{x:010d} 00000 n \n" for x in places)
    return out + f"xref\n0 {len(parts) + 1}\n0000000000 65535 f \n{table}trailer<</Size {len(parts) + 1}/Root 1 0 R>>startxref\n{len(out)}\n%%EOF\n".encode(), f"{size[0]}x{size[1]}"


def page_count(content: bytes) -> int:
    """Pages of a PDF whose page objects are not compressed; at least 1."""
    return max(1, len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", content)))
