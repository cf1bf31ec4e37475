from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airstrata.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"


def plain(rows, shortest=20, least=3):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            k = key(line)
            ids = [i for i in holders[k] if i is not None]
            gone = len(k) >= shortest and len(holders[k]) >= least and ids and doc != max(ids)
            if not gone:
                kept.append(line)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


SHARED = "this line stands in many documents"
ROWS = [
    (1, SHARED), (2, f"  {SHARED.upper()}\t\n\nown line of two"), (3, f"a\n{SHARED}\n{SHARED}\r\nb"),
    (4, "nineteen letters ab"), (5, "nineteen letters ab"), (6, "nineteen letters ab"),
    (7, "exactly twenty lette"), (8, "exactly twenty lette"), (9, "EXACTLY twenty lette "),
    (10, "twenty code points äö"), (11, "twenty code points äö"), (12, None), (13, ""), (14, "\n\n"),
    (3, f"a\n{SHARED}"), (None, f"{SHARED}\nx"), (None, "only nameless rows hold this"),
    (None, "only nameless rows hold this"), (None, "only nameless rows hold this"),
    (15, "\u00a0" + SHARED), (16, "Ä" * 20), (17, "ä" * 20), (18, "Ä" * 20), (19, "long\n" * 3000 + SHARED),
]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 3), (7, 2)])
def test_lines_match_brute_force(spark, batches, fanout):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    docs = docs.select("*", F.lit("kept").alias("batch"), F.lit(1).alias("line_hash"))
    found = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout)
    assert found.columns == ["doc_id", "text", "batch", "line_hash", "n_lines", "n_dropped"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert sorted(got, key=str) == plain(ROWS)


def test_thresholds_are_parameters(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "ab\nc")], "doc_id int, text string")
    found = line_dedup.dedup_lines(docs, min_length=2, min_documents=2)
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(1, ""), (2, "ab\nc")]
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_full_levels_are_compacted(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path), fanout=2)
    for i in range(7):
        lines = spark.createDataFrame([(i, 5, 6), (i, i, i)], "doc_id long, line_hash long, line_check int")
        runs.add(lines)
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    rows = {(r.line_hash, r.line_check): (r.n_docs, r.last_doc) for r in runs.merged().collect()}
    assert rows[5, 6] == (7, 6) and rows[5, 5] == (1, 5) and len(rows) == 8


def test_main_path_runs_no_python(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowColumn", "")


def test_batches_meet_runs_without_moving_them(spark, tmp_path):
    """Neither a merge nor the anti-join of a batch has an exchange above the runs."""
    runs = line_dedup.LineRuns(spark, str(tmp_path), fanout=3, enough=2)
    for i in (9, 8):
        runs.add(spark.createDataFrame([(i, 5, 6), (i, i, i)], "doc_id long, line_hash long, line_check int"))
    plan = runs.merged()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    # Line (5, 6) is settled by two documents, so a later batch adds nothing for it.
    runs.add(spark.createDataFrame([(7, 5, 6), (7, 9, 9)], "doc_id long, line_hash long, line_check int"))
    rows = {(r.line_hash, r.line_check): (r.n_docs, r.last_doc) for r in runs.merged().collect()}
    assert rows == {(5, 6): (2, 9), (9, 9): (2, 9), (8, 8): (1, 8)}
    assert [len(level) for level in runs.levels] == [0, 1]


def test_many_shared_lines_of_one_document(spark):
    """Repeated lines count once a document and all go; other lines keep their order."""
    lines = [f"shared line of many documents {i}" for i in range(4000)]
    rows = [(i, "\n".join([*lines, *lines[:50], f"own {i}", ""])) for i in range(1, 4)]
    rows += [(2, "another text of two\n" + lines[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(docs).collect()]
    assert sorted(found, key=str) == plain(rows)
