"""Figures that a write observes, and ids that differ in case or trailing blanks."""

from pyspark.sql import functions as F

from ledgerloom.operators import dedup, fanout, matching, profile
from ledgerloom.sources import io


def test_profile_while_storing(spark, fx, tmp_path):
    holes = dict(fx, sales_transactions=fx["sales_transactions"].withColumn("transaction_id", F.when(F.col("quantity") > 1, F.col("transaction_id"))))
    for k, tables in enumerate((holes, {t: df.limit(0) for t, df in fx.items()})):
        stored, figures = profile.store_profiled(tables, f"{tmp_path}/{k}")
        for name, want in (("a1_null_keys", io.null_key_counts(tables)), ("a3_table_row_counts", io.table_row_counts(tables)),
                           ("p2_completeness", profile.completeness(tables["sales_transactions"]))):
            assert sorted(map(str, figures[name].collect())) == sorted(map(str, want.collect())), name
        for t, df in tables.items():
            assert sorted(map(str, stored[t].collect())) == sorted(map(str, df.collect()))


def test_collated_ids_match_and_keep_their_spelling(spark, fx):
    other = {
        "gl_postings": fx["gl_postings"].withColumn("source_reference", F.concat(F.lower("source_reference"), F.lit("  "))),
        "bank_settlements": fx["bank_settlements"].withColumn("reference_id", F.initcap("reference_id")),
    }
    names = ("sales_transactions", "gl_postings", "bank_settlements")
    plain = [fx[n] for n in names]
    t = io.collated_keys(dict(fx, **other))
    odd = [t[n] for n in names]
    assert matching.reconciliation(fx["sales_transactions"], *[dict(fx, **other)[n] for n in names[1:]]) \
        .where("reconciliation_status <> 'MISSING_IN_GL'").isEmpty()
    text = lambda df: sorted(map(str, df.withColumn("transaction_id", F.collate("transaction_id", "UTF8_BINARY")).collect()))
    assert text(matching.reconciliation(*odd)) == text(matching.reconciliation(*plain))
    assert text(matching.gap_detection(*odd)) == text(matching.gap_detection(*plain))
    assert text(dedup.sales_deduplicated(odd[0])) == text(dedup.sales_deduplicated(plain[0]))
    assert sorted(map(str, fanout.status_totals(*odd).collect())) == sorted(map(str, fanout.status_totals(*plain).collect()))


def test_spellings_of_one_id_are_one(spark, fx):
    sales = fx["sales_transactions"].where("transaction_id = 'TXN-002'")
    both = sales.unionByName(sales.withColumn("transaction_id", F.lit("txn-002 ")))
    t = io.collated_keys({"sales_transactions": both, "gl_postings": fx["gl_postings"].limit(0), "bank_settlements": fx["bank_settlements"].limit(0)})
    assert matching.source_aggregated(t["sales_transactions"]).count() == 1
    assert dedup.sales_deduplicated(t["sales_transactions"]).count() == 1
    gaps = matching.gap_detection(*t.values()).collect()
    assert [(r.transaction_id, r.missing_from) for r in gaps] == [("TXN-002", "GL, BANK")]
