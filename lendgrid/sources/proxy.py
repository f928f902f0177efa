"""Credit tables derived from the TPC-H-like tables, with gaps in coverage.

Each view is a pure projection or filter (or one equi-join) of the given
tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lendgrid.functions.nullsafe import nan_to_null


# declared, so that building a plan reads no file footers
GIVEN = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.schema(GIVEN[name]).parquet(f"{folder}/{name}.parquet"))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    credit = (1000 + (key * 7919) % 90000).cast("double")
    return given(spark, folder, "customer").select(
        key.alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        credit.alias("AMT_CREDIT"),
        F.when(key % 97 == 0, F.lit(0.0)).otherwise(F.abs("c_acctbal")).alias("AMT_INCOME_TOTAL"),
        (credit / 20).alias("AMT_ANNUITY"),
        F.when(key % 53 != 0, credit * 0.9).alias("AMT_GOODS_PRICE"),
        F.when(F.col("c_nationkey") == 0, F.lit(365243)).otherwise(-(1 + (key * 13) % 9000)).cast("long").alias("DAYS_EMPLOYED"),
        (-(7400 + (key * 37) % 17000)).cast("long").alias("DAYS_BIRTH"),
        F.when(key % 31 != 0, F.col("c_mktsegment")).alias("NAME_FAMILY_STATUS"),
        (key % 2).cast("int").alias("CODE_GENDER_M"),
        (key % 4).cast("int").alias("CNT_CHILDREN"),
        (2 + key % 3).cast("double").alias("CNT_FAM_MEMBERS"),
    )


def application_train(spark: SparkSession, folder: str) -> DataFrame:
    return _customers(spark, folder).where(F.col("SK_ID_CURR") % 8 != 0)


def application_test(spark: SparkSession, folder: str) -> DataFrame:
    return _customers(spark, folder).where(F.col("SK_ID_CURR") % 8 == 0).drop("TARGET")


def bureau(spark: SparkSession, folder: str) -> DataFrame:
    price, priority, status = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return given(spark, folder, "orders").where(F.col("o_custkey") % 7 != 0).select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.when(status == "O", "Active").when(status == "F", "Closed").when(status == "P", "Sold").alias("CREDIT_ACTIVE"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(status != "P", price * 0.3).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(priority == "1-URGENT", price * 0.01).otherwise(F.lit(0.0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(priority != "5-LOW", price / 12).alias("AMT_ANNUITY"),
    )


def _flag_status() -> Column:
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "R", (1 + F.col("l_linenumber") % 5).cast("string"))
        .when(flag == "N", F.lit("0"))
        .when(flag == "A", F.lit("C"))
    )


def bureau_balance(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).cast("int").alias("MONTHS_BALANCE"),
        _flag_status().alias("STATUS"),
    )


def previous_application(spark: SparkSession, folder: str) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    named = F.when(status == "P", "Approved").when(status == "F", "Refused").when(status == "O", "Canceled")
    return given(spark, folder, "orders").where(F.col("o_custkey") % 5 != 0).select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.when(F.col("o_orderkey") % 41 != 0, named).alias("NAME_CONTRACT_STATUS"),
        price.alias("AMT_CREDIT"),
        (price / 24).alias("AMT_ANNUITY"),
        F.datediff(F.col("o_orderdate"), F.lit("2001-12-31").cast("date")).alias("DAYS_DECISION"),
    )


def _lines_of(spark: SparkSession, folder: str, keep: Column) -> DataFrame:
    orders = given(spark, folder, "orders").where(keep).select("o_orderkey", "o_custkey")
    return given(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def _days_past_due() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).otherwise(0).cast("int")


def pos_cash_balance(spark: SparkSession, folder: str) -> DataFrame:
    return _lines_of(spark, folder, F.col("o_orderpriority") == "3-MEDIUM").select(
        F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_orderkey").alias("SK_ID_PREV"),
        _days_past_due().alias("SK_DPD"),
    )


def credit_card_balance(spark: SparkSession, folder: str) -> DataFrame:
    keep = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") % 3 == 0)
    price = F.col("l_extendedprice")
    return _lines_of(spark, folder, keep).select(
        F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_orderkey").alias("SK_ID_PREV"),
        (price * F.col("l_discount")).alias("AMT_BALANCE"),
        F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(price * F.col("l_tax")).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        _days_past_due().alias("SK_DPD"),
    )


def installments_payments(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return _lines_of(spark, folder, F.col("o_custkey") % 11 != 0).select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(F.col("l_linenumber") != 7, (-125 + F.col("l_quantity")).cast("int")).alias("DAYS_ENTRY_PAYMENT"),
        F.lit(-100).alias("DAYS_INSTALMENT"),
        price.alias("AMT_INSTALMENT"),
        (price * (1 - F.col("l_discount"))).alias("AMT_PAYMENT"),
    )


VIEWS = {
    "application_train": application_train,
    "application_test": application_test,
    "bureau": bureau,
    "bureau_balance": bureau_balance,
    "previous_application": previous_application,
    "POS_CASH_balance": pos_cash_balance,
    "credit_card_balance": credit_card_balance,
    "installments_payments": installments_payments,
}


def credit_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: view(spark, folder) for name, view in VIEWS.items()}


def scored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as scored cases with many ties: id, y, p, group."""
    docs = given(spark, folder, "documents").select("doc_id", "lang", "n_chars", "source")
    return given(spark, folder, "labels").join(docs, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("y"),
        ((F.col("n_chars") % 1000) / 1000.0).alias("p"), F.col("lang").alias("group"), "toxic",
    )


def policy_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a policy corpus; ids are padded, so text order is number order."""
    return given(spark, folder, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("doc_id"),
        F.concat_ws(" ", F.lit("Doc"), F.col("doc_id").cast("string")).alias("title"),
        "text",
    )


def policy_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Questions: the whole benchmark texts."""
    return given(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
