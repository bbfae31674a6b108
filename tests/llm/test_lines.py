from collections import defaultdict

from helpers import documents, sha, table, whole
from pyspark.sql import functions as F

from kerbstone.llm.lines import LineRuns, dedup_lines, line_key

LONG = "This line is long enough to be looked at, really"


def expected(rows, min_chars=40, min_docs=5):
    holders = defaultdict(list)
    for doc, text in rows:
        for key in {line_key(x) for x in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if not (len(k := line_key(x)) >= min_chars and len(holders[k]) >= min_docs
                    and doc != max((h for h in holders[k] if h is not None), default=None))
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_edge_cases(spark):
    texts = [f"{i}\n {LONG.upper()}\t\n{LONG}" for i in range(5)] + [None, "", "\n\n", LONG[:39]]
    texts += [" " + LONG] * 4 + ["é" * 40] * 5 + ["x" * 300_000 + "\n" + LONG]
    rows = list(enumerate(texts)) + [(None, LONG), (2, LONG + "\nother")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    assert whole(dedup_lines(frame, keep=["doc_id"])) == expected(rows)


def test_given_table_in_any_number_of_batches(spark):
    docs = table(spark, "documents")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()], min_docs=2)
    for batches in (1, 7):
        assert whole(dedup_lines(docs, min_docs=2, batches=batches, keep=["doc_id"])) == want


def test_all_columns_pass(spark):
    out = dedup_lines(documents(spark, [LONG] * 6))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_dropped", "kept_text"]
    assert [r["kept_text"] for r in out.orderBy("doc_id").collect()] == [""] * 5 + [LONG]


def test_runs_are_compacted_and_owned_by_the_first_batch(spark):
    store = LineRuns(spark, fanout=2)
    for ids in ([9, 8], [7], [6, 5], [4]):
        store.add(spark.createDataFrame([(i, b"k") for i in ids], "id long, key binary"))
    assert [len(level) for level in store.levels] == [0, 0, 1]
    row = store.runs().first()
    assert (bytes(row["key"]), row["docs"], row["owner"]) == (b"k", 6, 9)


def test_empty_table(spark):
    assert dedup_lines(documents(spark, []).limit(0)).count() == 0
    assert sha("") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_rows_without_id_lose_their_own_lines_only(spark):
    """Each distinct text has its own set of lost lines, however many rows have no id."""
    lines = [f"line {i} of the boilerplate that goes around here" for i in range(30)]
    rows = [(i, "\n".join(lines)) for i in range(4)] + [(9, "\n".join(lines))]
    rows += [(None, f"{i}\n{lines[i]}\n{lines[(i * 7) % 30]}") for i in range(30)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert whole(dedup_lines(frame, keep=["doc_id"])) == expected(rows)


def test_query_equals_its_sql_with_repeated_ids(spark, tmp_path):
    import duckdb

    from kerbstone.llm.oracle import OP2
    from kerbstone.llm.queries import op2_line_dedup

    rows = [(i % 3, f"{LONG}\nrow {i % 2}") for i in range(9)] + [(5, LONG), (6, LONG + " too\n" + LONG), (7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = op2_line_dedup(spark, str(tmp_path))
    assert whole(got) == sorted(con.sql(f"SELECT {', '.join(got.columns)} FROM ({OP2})").fetchall(), key=repr)
