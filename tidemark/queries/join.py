"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.money import money_sum
from tidemark.operators import joins
from tidemark.queries.registry import CATEGORY_DIM, CLICKS, money, query
from tidemark.sources.clicks import PURCHASE, category_dimension, clicks, purchases
from tidemark.sources.readers import read_table

SALES = "sales AS (SELECT event_id, category FROM clicks WHERE event_type = 'purchase' AND category IS NOT NULL)"


def _sales(spark, sf):
    return purchases(clicks(spark, sf)).filter(F.col("category").isNotNull()).select("event_id", "category")


def _labels(spark, sf):
    return read_table(spark, sf, "labels")


def _documents(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", "lang", "source")


@query(f"{CLICKS}, {SALES}, {CATEGORY_DIM} SELECT category, event_id, department, tax_rate FROM sales JOIN dim USING (category)")
def jn_01_inner(spark, sf):
    return joins.inner_join(_sales(spark, sf), category_dimension(spark), "category")


@query("SELECT doc_id, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def jn_02_left(spark, sf):
    return joins.left_join(_documents(spark, sf), _labels(spark, sf), "doc_id")


@query("SELECT doc_id, quality, toxic, lang, source FROM labels RIGHT JOIN documents USING (doc_id)")
def jn_03_right(spark, sf):
    return joins.right_join(_labels(spark, sf), _documents(spark, sf), "doc_id")


@query("SELECT doc_id, quality, toxic, label FROM labels FULL JOIN (SELECT vec_id AS doc_id, label FROM embeddings) USING (doc_id)")
def jn_04_full(spark, sf):
    vectors = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return joins.full_join(_labels(spark, sf), vectors, "doc_id")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def jn_05_semi(spark, sf):
    return joins.semi_join(_documents(spark, sf), _labels(spark, sf), "doc_id")


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def jn_06_anti(spark, sf):
    return joins.anti_join(_documents(spark, sf), _labels(spark, sf), "doc_id")


@query(f"{CLICKS}, {SALES}, {CATEGORY_DIM} SELECT category, event_id, department, tax_rate FROM sales LEFT JOIN dim USING (category)")
def jn_07_broadcast(spark, sf):
    return joins.broadcast_join(_sales(spark, sf), category_dimension(spark), "category")


@query(
    f"SELECT p_type, count(*) AS n, {money('l_extendedprice')} AS revenue "
    "FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY p_type"
)
def jn_08_unhinted(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    parts = read_table(spark, sf, "part").select("p_partkey", "p_type")
    joined = joins.unhinted_join(lines, parts, "p_partkey")
    return joined.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), money_sum("l_extendedprice").alias("revenue")
    )


@query(
    "SELECT c_custkey, count(*) AS n FROM orders RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey"
)
def jn_09_join_then_count(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.facts_per_lookup_row(orders, read_table(spark, sf, "customer").select("c_custkey"), "c_custkey")


@query(
    f"""{CLICKS}, {CATEGORY_DIM}, joined AS (SELECT * FROM clicks LEFT JOIN dim USING (category) WHERE country = 'US' AND event_type = 'purchase')
  SELECT form, department, count(*) AS n FROM joined, (VALUES ('late'), ('early')) forms(form) GROUP BY form, department"""
)
def jn_10_late_and_early_filter(spark, sf):
    tests = [F.col("country") == "US", F.col("event_type") == PURCHASE]
    frame, dim = clicks(spark, sf), category_dimension(spark)
    forms = {
        "late": joins.late_filter(frame, dim, "category", tests),
        "early": joins.early_filter(frame, dim, "category", tests),
    }
    counts = [
        rows.groupBy(F.lit(form).alias("form"), "department").agg(F.count(F.lit(1)).alias("n"))
        for form, rows in forms.items()
    ]
    return counts[0].unionByName(counts[1])
