"""Pair tables: long conversations, kept tables, scratch."""

import pytest
from pyspark.sql import functions as F

from twinscope.sources import scratch, tables


@pytest.fixture
def folder(spark, tmp_path):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"one {t}") for t in (9998, 9999, 10000)]
    turns += [(2, t, "user", f"two {t}") for t in (0, 1)] + [(3, None, "user", "no turn"), (None, 4, "user", "no conversation")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_no_two_messages_share_a_number(spark, folder):
    pairs = tables.open_pairs(spark, folder).collect()
    assert len({p.id for p in pairs}) == len(pairs) and len({(p.qid1, p.qid2) for p in pairs}) == len(pairs)
    texts = sorted((p.question1 or "", p.question2 or "") for p in pairs)
    want = [("", "one 9998"), ("one 9998", "one 9999"), ("one 9999", "one 10000"), ("one 10000", ""), ("", "two 0"), ("two 0", "two 1"), ("two 1", "")]
    want += [(a, b) for t in ("no turn", "no conversation") for a, b in ((t, ""), ("", t))]
    assert texts == sorted(want)
    turns = tables.turn_pairs(spark, folder).collect()
    assert sorted((p.question1, p.question2, p.is_duplicate) for p in turns) == [
        ("one 9998", "one 10000", 1), ("one 9998", "one 9999", 0), ("one 9999", "one 10000", 0), ("two 0", "two 1", 1),
    ]
    assert len({p.id for p in turns}) == 4


def test_kept_tables_follow_their_sources(spark, folder):
    made = []

    def build():
        made.append(1)
        return tables.table(spark, folder, "conversations").agg(F.count(F.lit(1)).alias("n"))

    def count():
        return tables.kept_table(spark, folder, "count", ["conversations"], build).first().n

    assert count() == count() == 7 and len(made) == 1
    spark.createDataFrame([(9, 0, "user", "more")], "conv_id long, turn long, role string, text string").write.mode("append").parquet(f"{folder}/conversations.parquet")
    assert count() == 8 and len(made) == 2
    scratch.clear_scratch(spark)
    assert count() == 8 and len(made) == 3
