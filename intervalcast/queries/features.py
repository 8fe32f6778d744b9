"""Feature expressions and learned preprocessing."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import decade, log_size
from ..operators.features import add_angle_features, add_interval_features, add_size_features
from ..operators.preprocess import FeatureSpec, impute_means, preprocessing_stages
from ..sources.scratch import materialise
from .intervals import frame
from .registry import FRAME_SQL, query, rounded, table


@query(
    """SELECT event_id, CAST(month(ts) AS INTEGER) AS month,
              CAST(hour(ts) // 6 AS INTEGER) AS time_interval_num,
              round(sin(2 * pi() * (hour(ts) // 6) / 4), 6) + 0.0 AS time_sin,
              round(cos(2 * pi() * (hour(ts) // 6) / 4), 6) + 0.0 AS time_cos
       FROM events"""
)
def time_features(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    featured = add_interval_features(events, "ts").drop("ts", "month_sin", "month_cos")
    return rounded(featured, time_sin=6, time_cos=6)


@query(
    """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
              round(sin(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS month_sin,
              round(cos(2 * pi() * month(o_orderdate) / 12), 6) + 0.0 AS month_cos
       FROM orders"""
)
def month_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    featured = add_interval_features(orders, "o_orderdate").select(
        "o_orderkey", "month", "month_sin", "month_cos"
    )
    return rounded(featured, month_sin=6, month_cos=6)


def gappy_angles(spark, sf_dir):
    """Event values as degrees, missing where the event number is a multiple of ten."""
    gap = F.nullif(F.pmod(F.col("event_id"), F.lit(10)), F.lit(0)).isNull()
    angle = F.when(~gap, F.col("value") % 360)
    return table(spark, sf_dir, "events").select("event_id", angle.alias("angle"))


GAPPY_SQL = """
  SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN value % 360 END AS angle FROM events"""
FILLED_SQL = f"""
  SELECT event_id, coalesce(angle, avg(angle) OVER ()) AS angle FROM ({GAPPY_SQL})"""


@query(f"SELECT event_id, round(angle, 6) + 0.0 AS angle FROM ({FILLED_SQL})")
def impute_mean(spark, sf_dir):
    return rounded(impute_means(gappy_angles(spark, sf_dir), ["angle"]), angle=6)


@query(
    f"""SELECT event_id, round(sin(2 * pi() * angle / 360), 6) + 0.0 AS angle_sin,
               round(cos(2 * pi() * angle / 360), 6) + 0.0 AS angle_cos
        FROM ({FILLED_SQL})"""
)
def angle_features(spark, sf_dir):
    """Encoded after the gaps are filled, so no sine or cosine is missing."""
    filled = impute_means(gappy_angles(spark, sf_dir), ["angle"])
    featured = add_angle_features(filled, "angle", "angle").drop("angle")
    return rounded(featured, angle_sin=6, angle_cos=6)


@query(
    f"""SELECT user_id, event_type, interval_start,
               round(coalesce(condition, avg(condition) OVER ()), 5) + 0.0 AS condition
        FROM ({FRAME_SQL})"""
)
def impute_joined(spark, sf_dir):
    """Gaps left by the join with the condition feed, filled with the joined rows' mean."""
    rows = frame(spark, sf_dir).select("user_id", "event_type", "interval_start", "condition")
    return rounded(impute_means(rows, ["condition"]), condition=5)


@query(
    """SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0.0)), 6) + 0.0 AS log_area
       FROM customer"""
)
def log_area(spark, sf_dir):
    size = F.greatest("c_acctbal", F.lit(0.0))
    customers = table(spark, sf_dir, "customer")
    return rounded(customers.select("c_custkey", log_size(size).alias("log_area")), log_area=6)


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) // 10 * 10 AS INTEGER) AS decade FROM orders"""
)
def order_decade(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", decade(F.year("o_orderdate")).alias("decade"))


@query(
    """SELECT p_partkey, round(ln(1 + p_retailprice), 6) + 0.0 AS log_price,
              CAST(p_size // 10 * 10 AS INTEGER) AS size_decade
       FROM part"""
)
def size_features(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    featured = add_size_features(
        parts,
        size="p_retailprice",
        year="p_size",
        log_name="log_price",
        decade_name="size_decade",
    )
    return rounded(featured.select("p_partkey", "log_price", "size_decade"), log_price=6)


INDEX_SQL = """
  SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i
  FROM part GROUP BY p_type"""


@query(
    f"SELECT p_partkey, CAST(i AS DOUBLE) AS type_index FROM part JOIN ({INDEX_SQL}) USING (p_type)"
)
def string_index(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    indexer = StringIndexer(inputCol="p_type", outputCol="type_index", handleInvalid="keep")
    return indexer.fit(parts).transform(parts).select("p_partkey", "type_index")


@query(
    f"""WITH k AS ({INDEX_SQL}), n AS (SELECT count(*) AS n FROM k)
        SELECT p_partkey,
               repeat('0', CAST(i AS INTEGER)) || '1' || repeat('0', CAST(n - i AS INTEGER)) AS type_vector
        FROM part JOIN k USING (p_type) CROSS JOIN n"""
)
def one_hot(spark, sf_dir):
    """The vector written as digits: a place per type and one for null and unseen values."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    stages = [
        StringIndexer(inputCol="p_type", outputCol="i", handleInvalid="keep"),
        OneHotEncoder(inputCols=["i"], outputCols=["v"], handleInvalid="keep"),
    ]
    encoded = Pipeline(stages=stages).fit(parts).transform(parts)
    digits = F.transform(vector_to_array("v"), lambda x: x.cast("int").cast("string"))
    return encoded.select("p_partkey", F.array_join(digits, "").alias("type_vector"))


SPEC = FeatureSpec(
    numeric=("log_area", "condition"),
    categorical=("segment", "event_type"),
    order=(
        "log_area",
        "condition",
        "time_sin",
        "time_cos",
        "month_sin",
        "month_cos",
        "segment",
        "event_type",
    ),
)


def model_features(rows):
    """What the models of the test tables need, for training, tables and streams alike."""
    sized = rows.withColumn("log_area", log_size(F.col("area")))
    return add_interval_features(sized, "interval_start")


def model_frame(spark, sf_dir):
    """The training frame, unrounded, with the models' features."""
    return model_features(frame(spark, sf_dir))


@query(
    f"""WITH f AS (SELECT *, ln(1 + area) AS la, hour(interval_start) // 6 AS i,
                          month(interval_start) AS m FROM ({FRAME_SQL})),
             w AS (SELECT 6 + (SELECT count(DISTINCT segment) FROM f) + 1
                            + (SELECT count(DISTINCT event_type) FROM f) + 1 AS width)
        SELECT user_id, event_type, interval_start, CAST(width AS INTEGER) AS width,
               round(coalesce(la, avg(la) OVER ()) + coalesce(condition, avg(condition) OVER ())
                     + sin(2 * pi() * i / 4) + cos(2 * pi() * i / 4)
                     + sin(2 * pi() * m / 12) + cos(2 * pi() * m / 12) + 2, 5) + 0.0 AS total_of_parts
        FROM f CROSS JOIN w"""
)
def feature_vector(spark, sf_dir):
    """Width of the assembled vector and the sum of its parts, for every row."""
    rows = materialise(model_frame(spark, sf_dir), "frame")
    stages = Pipeline(stages=preprocessing_stages(SPEC)).fit(rows)
    parts = vector_to_array("features")
    out = stages.transform(rows).select(
        "user_id",
        "event_type",
        "interval_start",
        F.size(parts).alias("width"),
        F.aggregate(parts, F.lit(0.0), lambda a, x: a + x).alias("total_of_parts"),
    )
    return rounded(out, total_of_parts=5)
