"""Declared schemas of the files read and written."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


ORDER_ITEMS = _struct(
    order_id=T.StringType(),
    order_item_id=T.IntegerType(),
    product_id=T.StringType(),
    seller_id=T.StringType(),
    price=T.DoubleType(),
    dt_purchase=T.TimestampType(),
    dt_approved=T.TimestampType(),
    days_approved=T.DoubleType(),
    days_shipping=T.DoubleType(),
    delayed_shipping=T.BooleanType(),
    review_score=T.IntegerType(),
    distance=T.DoubleType(),
)

PRODUCTS = _struct(product_id=T.StringType(), category=T.StringType())

CLUSTERED_ITEMS = T.StructType(
    ORDER_ITEMS.fields
    + _struct(category=T.StringType(), cluster=T.StringType()).fields
)

SERIES = _struct(
    dates=T.DateType(),
    orders=T.DoubleType(),
    avg_price=T.DoubleType(),
    revenue=T.DoubleType(),
)

# Star-schema tables behind the marketplace views (FIXTURES.md section 2).
STAR = {
    "region": _struct(r_regionkey=T.IntegerType(), r_name=T.StringType()),
    "nation": _struct(
        n_nationkey=T.IntegerType(), n_name=T.StringType(), n_regionkey=T.IntegerType()
    ),
    "customer": _struct(
        c_custkey=T.LongType(),
        c_name=T.StringType(),
        c_nationkey=T.IntegerType(),
        c_acctbal=T.DoubleType(),
        c_mktsegment=T.StringType(),
    ),
    "supplier": _struct(
        s_suppkey=T.LongType(),
        s_name=T.StringType(),
        s_nationkey=T.IntegerType(),
        s_acctbal=T.DoubleType(),
    ),
    "part": _struct(
        p_partkey=T.LongType(),
        p_name=T.StringType(),
        p_brand=T.StringType(),
        p_type=T.StringType(),
        p_size=T.IntegerType(),
        p_retailprice=T.DoubleType(),
    ),
    "orders": _struct(
        o_orderkey=T.LongType(),
        o_custkey=T.LongType(),
        o_orderstatus=T.StringType(),
        o_totalprice=T.DoubleType(),
        o_orderdate=T.TimestampNTZType(),
        o_orderpriority=T.StringType(),
    ),
    "lineitem": _struct(
        l_orderkey=T.LongType(),
        l_partkey=T.LongType(),
        l_suppkey=T.LongType(),
        l_linenumber=T.IntegerType(),
        l_quantity=T.DoubleType(),
        l_extendedprice=T.DoubleType(),
        l_discount=T.DoubleType(),
        l_tax=T.DoubleType(),
        l_returnflag=T.StringType(),
        l_linestatus=T.StringType(),
        l_shipdate=T.TimestampNTZType(),
    ),
}
