from collections import defaultdict

from muster.llm.line_dedup import dedup_lines
from muster.llm.oracle import ORACLE
from muster.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def plain_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(pairs, least):
    """(id, kept text, lines, dropped) of every row."""
    having = defaultdict(set)
    for doc_id, text in pairs:
        for line in (text or "").split("\n"):
            having[plain_key(line)].add(doc_id)
    out = []
    for doc_id, text in pairs:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not plain_key(line) or len(having[plain_key(line)]) < least]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(frame, least):
    rows = dedup_lines(frame, min_documents=least).select("document.doc_id", "kept_text", "n_lines", "n_dropped")
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def test_lines_of_many_documents_go(documents):
    pairs = [(i, f"own {i}\nShared LINE \n\n  shared line\r\nÉcole\nécole") for i in range(3)] + [(9, "École\nother")]
    assert got(documents(pairs), 3) == plain(pairs, 3)
    assert got(documents(pairs), 4) == plain(pairs, 4)


def test_odd_rows(documents):
    long = "\n".join(f"line {i % 700}" for i in range(20_000))
    pairs = [(1, None), (1, ""), (None, "a\nb"), (None, "a"), (2, "a\nb"), (2, "a\nb"), (3, long), (4, "\n\n"), (5, " \t")]
    for least in (1, 2, 3):
        assert got(documents(pairs), least) == plain(pairs, least)


def test_empty_table(documents):
    assert dedup_lines(documents([])).collect() == []


def test_all_columns_come_back(documents):
    frame = documents([(1, "a")])
    assert dedup_lines(frame).select("document.*").columns == frame.columns


def test_query_equals_sql(spark):
    from checks.compare import connect, normal_rows

    sf = "/root/testdata/sf0.001"
    frame = QUERIES["op6_line_dedup"](spark, sf)
    want = connect(sf).execute(ORACLE["op6_line_dedup"])
    columns = [d[0] for d in want.description]
    assert normal_rows(frame.columns, frame.collect()) == normal_rows(columns, want.fetchall())


def test_a_hot_line_is_split(spark, documents):
    """A line of all documents is dealt out to several tasks where it meets the list of shared lines."""
    frame = documents([(i, f"own {i}\ncommon\nown too {i}") for i in range(20_000)], clashing=False)
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in low}
    for name, value in low.items():
        spark.conf.set(name, value)
    try:
        result = dedup_lines(frame).select("document.doc_id", "kept_text")
        rows = result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(rows) == [(i, f"own {i}\nown too {i}") for i in range(20_000)]
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
