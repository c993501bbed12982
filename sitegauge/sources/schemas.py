"""Explicit input schemas (FIXTURES.md section 1). Inputs are never inferred."""

from pyspark.sql import types as T

# Vendor columns of the price log, in file order.
VENDORS = ("apple", "amazon", "adorama", "macmall", "bestbuy", "b_and_h")

PRICE_LOG_TEXT = T.StructType(
    [T.StructField("product", T.StringType())]
    + [T.StructField(v, T.StringType()) for v in VENDORS]
    + [T.StructField("date", T.StringType())])

PRICE_LOG = T.StructType(
    [T.StructField("product", T.StringType())]
    + [T.StructField(v, T.DoubleType()) for v in VENDORS]
    + [T.StructField("date", T.StringType())])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

ROSTER = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("district", T.StringType()),
])

HIERARCHY = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("owner_name", T.StringType()),
    T.StructField("owner_number", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
])

# Survey questions kept after layout normalisation.
QUESTIONS = ("Q7", "Q8", "Q9", "Q10", "Q11", "Q12", "Q14", "Q18")

SURVEY = T.StructType(
    [T.StructField("site_id", T.StringType()),
     T.StructField("wave_id", T.StringType()),
     T.StructField("territory_manager", T.StringType()),
     T.StructField("sales_manager", T.StringType())]
    + [T.StructField(q.lower(), T.StringType()) for q in QUESTIONS]
    + [T.StructField("experience_score", T.DoubleType())])

VOLUME = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("volume", T.DecimalType(18, 2)),
    T.StructField("premium_volume", T.DecimalType(18, 2)),
])

LOYALTY_RECORD = T.StructType([
    T.StructField("location_master", T.StructType([
        T.StructField("location_number", T.StringType())])),
    T.StructField("day", T.DateType()),
    T.StructField("loyalty_volume", T.DecimalType(21, 4)),
])

REGION_ASSIGNMENT = T.StructType([
    T.StructField("territory_manager", T.StringType()),
    T.StructField("region", T.StringType()),
])

# The driver's tables used as stand-in inputs (FIXTURES.md section 4), declared
# so that reading them needs no schema-inference job.
_NTZ = T.TimestampNTZType()
DRIVER_TABLES = {
    "region": T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                            T.StructField("r_name", T.StringType())]),
    "nation": T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                            T.StructField("n_name", T.StringType()),
                            T.StructField("n_regionkey", T.IntegerType())]),
    "customer": T.StructType([T.StructField("c_custkey", T.LongType()),
                              T.StructField("c_name", T.StringType()),
                              T.StructField("c_nationkey", T.IntegerType()),
                              T.StructField("c_acctbal", T.DoubleType()),
                              T.StructField("c_mktsegment", T.StringType())]),
    "supplier": T.StructType([T.StructField("s_suppkey", T.LongType()),
                              T.StructField("s_name", T.StringType()),
                              T.StructField("s_nationkey", T.IntegerType()),
                              T.StructField("s_acctbal", T.DoubleType())]),
    "part": T.StructType([T.StructField("p_partkey", T.LongType()),
                          T.StructField("p_name", T.StringType()),
                          T.StructField("p_brand", T.StringType()),
                          T.StructField("p_type", T.StringType()),
                          T.StructField("p_size", T.IntegerType()),
                          T.StructField("p_retailprice", T.DoubleType())]),
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderstatus", T.StringType()),
                            T.StructField("o_totalprice", T.DoubleType()),
                            T.StructField("o_orderdate", _NTZ),
                            T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([T.StructField("l_orderkey", T.LongType()),
                              T.StructField("l_partkey", T.LongType()),
                              T.StructField("l_suppkey", T.LongType()),
                              T.StructField("l_linenumber", T.IntegerType()),
                              T.StructField("l_quantity", T.DoubleType()),
                              T.StructField("l_extendedprice", T.DoubleType()),
                              T.StructField("l_discount", T.DoubleType()),
                              T.StructField("l_tax", T.DoubleType()),
                              T.StructField("l_returnflag", T.StringType()),
                              T.StructField("l_linestatus", T.StringType()),
                              T.StructField("l_shipdate", _NTZ)]),
    "pages": PAGES,
}
