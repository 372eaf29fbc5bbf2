"""Vacancy-shaped tables derived from the driver tables.

No vacancy data set is supplied, so the registered queries read the TPC-H-like tables and map
their columns onto the vacancy model. Every mapping is a plain projection or equi-join over the
whole tables, so the work grows with the data. The same mappings are written in DuckDB SQL in
``labormart.plans.oracle`` for the correctness check.

Recipes (``%`` below derives values, it never filters rows):

* ``orders_vacancies`` (clean shape, one row per order):
  orders ⋈ customer ⋈ nation; id = o_orderkey, name = o_orderpriority, area = n_name (null when
  o_orderkey % 13 = 0), employer = c_name, salary_from = floor(o_totalprice) (0 when
  o_orderkey % 7 = 0), salary_to = salary_from + (o_orderkey % 10) * 10000 (0 when
  o_orderkey % 11 = 0), published_at = o_orderdate as ISO text.
* ``raw_vacancies`` (nested raw shape, one record per line item, so every order id is collected
  one to seven times): lineitem ⋈ orders ⋈ customer ⋈ nation, see the function for the fields.
* ``text_vacancies``: documents (id = doc_id, area = lang, employer = source,
  requirement = text) unioned with pages (id = 'p' || page_id, area = 'web', employer = url
  host part, requirement = html).
* ``event_vacancies``: events as a vacancy stream; ts is the event time, area = event_type,
  salary_from = floor(value * 1000), salary_to = floor(value * 1500), requirement = the text of
  document ``user_id`` and ``skills`` = the literal keywords found in it (matched per document).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.functions import iso_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation, the employer and area of an order's customer. Spark picks the join
    strategy from table statistics (and AQE at run time); nothing is broadcast by hint."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                        "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")


def orders_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    j = orders.join(_order_dims(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "inner")
    k = F.col("o_orderkey")
    base = F.floor("o_totalprice").cast("bigint")
    salary_from = F.when(k % 7 == 0, F.lit(0).cast("bigint")).otherwise(base)
    salary_to = F.when(k % 11 == 0, F.lit(0).cast("bigint")).otherwise(
        salary_from + (k % 10) * 10000)
    return j.select(
        k.cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        iso_text("o_orderdate").alias("published_at"),
        iso_text("o_orderdate").alias("collected_at"),
        salary_from.alias("salary_from"),
        salary_to.alias("salary_to"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("area_name"),
        F.col("c_name").alias("employer_name"),
        F.lit(None).cast("string").alias("snippet_requirement"),
    )


def raw_vacancies(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Nested raw records, one per line item; ``id`` repeats for the lines of one order. Source columns
    named in ``keep`` are carried along, last.

    * name: o_orderpriority, but the one-letter o_orderstatus when l_returnflag = 'R' (too
      short, removed by cleaning and rejected by validation).
    * salary: null when l_linenumber = 6; from: null when l_linenumber = 7, negative when
      l_discount = 0, decimal text when l_linenumber = 5, else floor(l_extendedprice);
      to: floor(l_extendedprice / 2) when l_returnflag = 'A' (below from), times 200 when
      l_quantity = 50 (may pass 10M), else floor(l_extendedprice * (1 + l_tax)).
    * area: id and name of the customer's nation, id empty when c_mktsegment = 'AUTOMOBILE'.
    * collected_at: l_shipdate plus l_linenumber minutes, as ISO text (unique per id).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    # Orders meet their customers first, so the largest table is shuffled once.
    dims = orders.join(_order_dims(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "inner")
    j = li.join(dims, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    price = F.col("l_extendedprice")
    ln = F.col("l_linenumber")
    s_from = (F.when(ln == 7, F.lit(None).cast("string"))
               .when(F.col("l_discount") == 0, (-F.floor(price)).cast("string"))
               .when(ln == 5, price.cast("string"))
               .otherwise(F.floor(price).cast("string")))
    s_to = (F.when(F.col("l_returnflag") == "A", F.floor(price / 2))
             .when(F.col("l_quantity") == 50, F.floor(price) * 200)
             .otherwise(F.floor(price * (1 + F.col("l_tax"))))).cast("string")
    salary = F.when(ln == 6, F.lit(None)).otherwise(F.struct(
        s_from.alias("from"), s_to.alias("to"), F.lit("RUR").alias("currency"),
        F.lit(False).alias("gross")))
    collected = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), ln)
    return j.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.when(F.col("l_returnflag") == "R", F.col("o_orderstatus"))
         .otherwise(F.col("o_orderpriority")).alias("name"),
        salary.alias("salary"),
        F.struct(F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(""))
                  .otherwise(F.col("n_nationkey").cast("string")).alias("id"),
                 F.col("n_name").alias("name")).alias("area"),
        F.struct(F.col("c_custkey").cast("string").alias("id"),
                 F.col("c_name").alias("name")).alias("employer"),
        F.struct(F.col("c_mktsegment").alias("requirement"),
                 F.col("o_orderpriority").alias("responsibility")).alias("snippet"),
        iso_text("o_orderdate").alias("published_at"),
        iso_text(collected).alias("collected_at"),
        *keep,
    )


def text_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("area_name"),
        F.col("source").alias("employer_name"),
        F.col("text").alias("snippet_requirement"))
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
        F.lit("web").alias("area_name"),
        F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("employer_name"),
        F.col("html").alias("snippet_requirement"))
    return docs.unionByName(pages)


def event_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as vacancies with an event-time column ``ts`` (TIMESTAMP_NTZ as stored)."""
    from labormart.operators.skills import row_skills

    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # Keywords are matched once per document here, not once per event that refers to it.
    docs = row_skills(table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("user_id"), F.col("text").alias("snippet_requirement")),
        "snippet_requirement")
    return ev.join(docs, "user_id", "left").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts"),
        F.col("event_type").alias("area_name"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("salary_from"),
        F.floor(F.col("value") * 1500).cast("bigint").alias("salary_to"),
        F.col("snippet_requirement"),
        F.col("skills"),
    )
