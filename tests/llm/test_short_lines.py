"""Equal lines that are shorter than those compared for an edit."""

import random
import corpus_pipeline
from ledgerloom.llm import line_dedup

DATA = [(1, "Short one.\n\nShort two.\nA line that is long enough to be compared."), (2, " Short one.\r\n\nShort twa.\nA line that is long enough to be compared!"), (3, "Short two.\nShort two.\n\n  ")]


def test_equal_short_lines_go_from_the_pipeline(spark):
    df = spark.createDataFrame(DATA, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, df, "").collect()}
    assert got == {1: DATA[0][1], 2: "\nShort twa.", 3: "\n  "}


def test_a_least_length_for_equal_lines(spark):
    df = spark.createDataFrame(DATA, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedupe_lines(df).collect()} == {1: DATA[0][1], 2: " Short one.\r\n\nShort twa.", 3: DATA[2][1]}


def test_the_query_drops_lines_an_edit_of_a_word_apart(spark, tmp_path):
    """op6_line_dedup and its SQL: a word of a line of eight goes as one edit, of seven not; a character of any."""
    import duckdb

    from ledgerloom.llm import queries

    eight, seven = "one two three four five six seven eight", "another line that has only seven words"
    texts = [eight, eight.replace("four", "other"), seven, seven.replace("only", "just"), eight + " nine", seven + "s", "only seven words, but a letter more\nx"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert {d for d, t, _, _ in got if t == ""} == {1, 4, 5}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {*duck.execute(queries.oracle_sql()["op6_line_dedup"]).fetchall()} == got


def test_lines_one_word_apart_move_few_bytes(spark):
    """Lines that share halves of words only: no arrays of characters are shuffled, nor blocks of the way in which they share none."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 12)))
    docs = []
    for _ in range(150):
        line = [word() for _ in range(60)]
        docs += [" ".join(line), " ".join([*line[:30], word() + "z" * rnd.randint(1, 9), *line[31:]])]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    before, threshold = _written(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    kept = [r[0] for r in line_dedup.dedupe_lines(df, exact_chars=1, min_words=line_dedup.MIN_WORDS).orderBy("doc_id").select("text").collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    moved = sum(n for k, n in _written(spark).items() if k not in before)
    assert kept == [t if i % 2 == 0 else "" for i, t in enumerate(docs)]
    assert moved < 22 * sum(map(len, docs)), (moved, sum(map(len, docs)))


def _written(spark):
    """Bytes that each stage so far has written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}
