"""SRC-1 line files, SRC-4 stop-word files, SRC-5 file streams, SNK-3/4 console."""

from spindle.operators import text
from spindle.sources import read_lines, read_stopwords, stream_lines
from spindle.streaming import counts, sinks
from spindle.streaming.run import run_to_end, start


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_read_lines_terminators(spark, tmp_dir):
    _write(f"{tmp_dir}/a.txt", b"x y\r\nz\n\nlast\n")
    lines = [r.value for r in read_lines(spark, f"{tmp_dir}/a.txt").collect()]
    assert lines == ["x y", "z", "", "last"]


def test_read_stopwords_exact(spark, tmp_dir):
    _write(f"{tmp_dir}/stop.txt", b"the\na\nand\nthe\n")
    stop = read_stopwords(spark, f"{tmp_dir}/stop.txt")
    words = text.clean_words(spark.createDataFrame([("The the a an",)], "value string"))
    kept = sorted(r.word for r in text.drop_stopwords(words, stop).collect())
    assert kept == ["The", "an"]


def test_text_file_stream_and_console(spark, tmp_dir, capsys):
    import os
    os.makedirs(f"{tmp_dir}/in")
    _write(f"{tmp_dir}/in/1.txt", b"a a b\n")
    _write(f"{tmp_dir}/in/2.txt", b"a c\n\n")
    seen = {}

    def per_batch(df, bid):
        res = counts.count_per_batch(df)
        seen[bid] = sorted((r.word, r.n) for r in res.collect())
        sinks.console(res.orderBy("word"), bid)

    q = start(counts.stream_words(stream_lines(spark, f"{tmp_dir}/in", max_files_per_trigger=1)),
              f"{tmp_dir}/ck", foreach_batch=per_batch, available_now=True)
    run_to_end(q, 120)
    assert sorted(seen.values()) == sorted([[("a", 2), ("b", 1)], [("", 1), ("a", 1), ("c", 1)]])
    import re
    times = re.findall(r"========= batch (\d) at (\d{13}) =========", capsys.readouterr().out)
    assert [b for b, _ in times] == ["0", "1"] and times[0][1] <= times[1][1]


def test_processing_time_trigger_and_console_sink(spark, tmp_dir):
    """STR-1 cadence with Spark's console sink (SNK-3); the query is stopped by the caller."""
    import os
    os.makedirs(f"{tmp_dir}/in")
    _write(f"{tmp_dir}/in/1.txt", b"x y x\n")
    words = counts.count_per_batch(counts.stream_words(stream_lines(spark, f"{tmp_dir}/in")))
    q = start(words, f"{tmp_dir}/ck", output_mode="complete", processing_time="1 second",
              fmt="console", options={"numRows": 10, "truncate": "false"}, query_name="cadence_test")
    try:
        q.processAllAvailable()
        assert q.isActive and sum(p["numInputRows"] for p in q.recentProgress) == 1  # one line
        assert q.name == "cadence_test"
    finally:
        q.stop()
