"""Models fitted with MLlib on the feature frames.

Fitting reads its input many times, so each feature frame is checkpointed first: the events are
scanned once, and a lost executor reads the compact frame again.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.features import dense_ids, purchase_counts, session_features, user_features
from eventlake.sources.scratch import cut_lineage


def recommendations(
    silver: DataFrame, top: int = 10, rank: int = 10, seed: int = 7, users: DataFrame | None = None
) -> DataFrame:
    """Products with the highest predicted preference per user, best first.

    With ``users`` (a frame with ``user_id``) only those are scored against the products.
    """
    ratings = cut_lineage(purchase_counts(silver))
    items = cut_lineage(dense_ids(ratings, "product_id", "item"))
    als = ALS(
        userCol="user_id", itemCol="item", ratingCol="purchases", implicitPrefs=True,
        maxIter=10, regParam=0.01, rank=rank, coldStartStrategy="drop", seed=seed,
    )
    model = als.fit(ratings.join(items, "product_id").select("user_id", "item", "purchases"))
    scored = model.recommendForAllUsers(top) if users is None else model.recommendForUserSubset(users, top)
    ranked = scored.select(
        "user_id", F.posexplode("recommendations").alias("position", "r")
    )
    return ranked.join(items, F.col("r.item") == items["item"]).select(
        "user_id", (F.col("position") + 1).alias("rank"), "product_id", F.col("r.rating").alias("score")
    )


def customer_segments(silver: DataFrame, k: int = 4, seed: int = 7) -> DataFrame:
    """Cluster buyers by frequency, order value and category preference."""
    features = cut_lineage(user_features(silver))
    columns = [c for c in features.columns if c != "user_id"]
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
            KMeans(featuresCol="scaled", predictionCol="segment", k=k, seed=seed, maxIter=100, tol=0.0),
        ]
    )
    return steps.fit(features).transform(features).select("user_id", *columns, "segment")


def conversion_scores(session_rows: DataFrame) -> DataFrame:
    """Probability that a session converts, from what it did besides buying."""
    features = cut_lineage(session_features(session_rows))
    inputs = ["other_events", "views", "cart_adds", "duration_seconds"]
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=inputs, outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
            LogisticRegression(featuresCol="scaled", labelCol="converted", maxIter=50, regParam=0.01),
        ]
    )
    scored = steps.fit(features).transform(features)
    return scored.select(
        "user_id", "session_start", *inputs, "converted",
        vector_to_array("probability")[1].alias("conversion_probability"),
    )


# --- facts that hold for any correct fit ---------------------------------------------------------


def recommendation_facts(ranked: DataFrame, silver: DataFrame) -> DataFrame:
    """Per user: how many products, whether ranks have no gap, products are known and scores fall."""
    products = purchase_counts(silver).select("product_id").distinct().withColumn("known", F.lit(True))
    listed = ranked.join(products, "product_id", "left").groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("list"),
        F.bool_and(F.col("known").isNotNull()).alias("known_products"),
        F.count_distinct("product_id").alias("products"),
    )
    ranks = F.transform("list", lambda r: r["rank"].cast("int"))
    falls = F.transform("list", lambda r, i: F.coalesce(r["score"] >= F.get("list", i + 1)["score"], F.lit(True)))
    return listed.select(
        "user_id", "products", (ranks == F.sequence(F.lit(1), F.col("products").cast("int"))).alias("ranks_without_gap"),
        "known_products", F.forall(falls, lambda x: x).alias("scores_fall"),
    )


def segment_facts(segments: DataFrame) -> DataFrame:
    """Per buyer: whether no other segment's mean is nearer, on features scaled to unit deviation."""
    names = [c for c in segments.columns if c not in ("user_id", "segment")]
    spread = segments.agg(*[F.stddev(c).alias(c) for c in names])
    scales = [F.when(spread.select(c).scalar() > 0, 1 / spread.select(c).scalar()).otherwise(0.0) for c in names]
    scaled = cut_lineage(
        segments.select("user_id", "segment", *[(F.col(c) * s).alias(c) for c, s in zip(names, scales)])
    )
    # One row per segment.
    means = scaled.groupBy("segment").agg(F.array(*[F.avg(c) for c in names]).alias("mean"))
    centres = means.agg(F.sort_array(F.collect_list(F.struct("segment", "mean"))).alias("centres")).scalar()
    own = scaled.withColumn("point", F.array(*names)).withColumn("centres", centres)

    def gap(centre):
        parts = F.zip_with(centre["mean"], F.col("point"), lambda a, b: (a - b) * (a - b))
        return F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)

    distances = F.transform("centres", lambda c: F.struct(gap(c).alias("gap"), c["segment"].alias("segment")))
    return own.withColumn("distances", distances).select(
        "user_id",
        (F.filter("distances", lambda d: d["segment"] == F.col("segment"))[0]["gap"] <= F.array_min("distances")["gap"] + 1e-9).alias("nearest"),
    )


def conversion_facts(scored: DataFrame) -> DataFrame:
    """The intercept is fitted without a penalty, so its gradient is 0: the mean probability is the share that converted."""
    p = F.col("conversion_probability")
    return scored.agg(
        F.count("*").alias("sessions"), F.sum("converted").alias("converted"),
        (F.abs(F.avg(p) - F.avg("converted")) < 1e-4).alias("gradient_is_zero"), F.bool_and(p.between(0, 1)).alias("probabilities"),
    )
