"""Feature views: materialise, incremental materialise, online lookup, point-in-time join."""

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.balance import bucket_by, bucket_count, hot_keys, split_points
from millrace.operators.ordered import latest_by


@dataclass(frozen=True)
class FeatureView:
    """What a feature table holds: its key, times, lifetime and typed fields."""

    name: str
    entity: str
    event_time: str
    features: dict
    created: str | None = None
    ttl: timedelta | None = None
    tags: dict = field(default_factory=dict)

    def problems(self, df: DataFrame) -> list[str]:
        """Differences between the definition and the schema of `df`."""
        types = dict(df.dtypes)
        needed = [self.entity, self.event_time] + ([self.created] if self.created else [])
        found = [f"missing column {c}" for c in needed if c not in types]
        for name, kind in self.features.items():
            if name not in types:
                found.append(f"missing feature {name}")
            elif types[name] != kind:
                found.append(f"feature {name} is {types[name]}, not {kind}")
        return found

    def check(self, df: DataFrame) -> DataFrame:
        wrong = self.problems(df)
        if wrong:
            raise ValueError(f"{self.name}: " + "; ".join(wrong))
        return df

    @property
    def versions(self) -> list[str]:
        return [self.event_time] + ([self.created] if self.created else [])


def materialize(df: DataFrame, view: FeatureView) -> DataFrame:
    """Newest row per entity, by event time and then creation."""
    view.check(df)
    return latest_by(df, [view.entity], view.versions, view.versions + list(view.features))


def materialize_incremental(state: DataFrame | None, df: DataFrame, view: FeatureView,
                            since, until) -> DataFrame:
    """New state after adding the rows with `since` < event time <= `until`."""
    moment = F.col(view.event_time)
    fresh = df.filter(moment <= F.lit(until))
    if since is not None:
        fresh = fresh.filter(moment > F.lit(since))
    fresh = materialize(fresh, view)
    return fresh if state is None else materialize(state.unionByName(fresh), view)


def get_online_features(store: DataFrame, requests: DataFrame, view: FeatureView, names,
                        position: str = "position") -> DataFrame:
    """One row per request whose entity is known; unknown feature names give null.

    Requests carry their place in `position`, so order and repeats survive. The
    store has one row per entity; adaptive execution splits an entity asked for very often.
    """
    wanted = [F.col(n) if n in store.columns else F.lit(None).cast("double").alias(n) for n in names]
    return (
        requests.select(position, view.entity).join(store, view.entity)
        .select(position, view.entity, *wanted)
    )


def online_misses(store: DataFrame, requests: DataFrame, view: FeatureView) -> DataFrame:
    """Requests for entities the store does not hold."""
    missing = requests.select(view.entity).distinct().join(store.select(view.entity), view.entity, "left_anti")
    return requests.join(missing, view.entity).select(*requests.columns)


def get_historical_features(entities: DataFrame, features: DataFrame, view: FeatureView,
                            at: str = "entity_ts", keep=()) -> DataFrame:
    """Point-in-time left join: the newest feature row at or before each entity time.

    A match older than the view's lifetime is blanked after matching; a row whose
    feature values are null still counts as the newest. Among feature rows of one
    (entity, event time) the latest created wins.

    Both sides are laid on one time line per entity and the last feature row is
    carried forward, in a single shuffle. Entities holding more rows than a fair
    share of one partition are cut into time buckets; the last row of each of
    their buckets (a bounded number) is carried across to the next ones.
    """
    view.check(features)
    names = list(view.features)
    payload = [view.event_time] + names
    newest = latest_by(features, [view.entity, view.event_time],
                       [view.created or view.event_time], names)
    kind = dict(newest.select(F.struct(*payload).alias("p")).dtypes)["p"]
    keep = list(keep)
    requests = entities.select(
        view.entity, F.col(at).alias("_at"), F.struct(*(keep or [at])).alias("_keep"),
        F.lit(None).cast(kind).alias("_row"), F.lit(1).alias("_side"))
    rows = newest.select(
        view.entity, F.col(view.event_time).alias("_at"),
        F.lit(None).cast(requests.schema["_keep"].dataType).alias("_keep"),
        F.struct(*payload).alias("_row"), F.lit(0).alias("_side"))
    line = requests.unionByName(rows)

    hot = hot_keys(line.select(view.entity), [view.entity]).withColumn("_hot", F.lit(True))
    moment = F.col("_at").cast("timestamp") if dict(line.dtypes)["_at"].startswith("timestamp") else F.col("_at")
    line = line.join(F.broadcast(hot), view.entity, "left")
    buckets = bucket_count(line)
    splits = line.filter(F.col("_hot")).agg(split_points(moment, buckets)).scalar()
    line = bucket_by(line, moment, splits, "_slot", buckets).withColumn(
        "_slot", F.when(F.col("_hot"), F.col("_slot")).otherwise(F.lit(-1)))
    upto = (W.partitionBy(view.entity, "_slot").orderBy("_at", "_side")
            .rowsBetween(W.unboundedPreceding, 0))
    matched = line.withColumn("_match", F.last("_row", ignorenulls=True).over(upto))

    # hot entities only; the rows above already lie by (entity, slot), so this join moves `ends` alone
    ends = (
        line.filter(F.col("_hot")).groupBy(view.entity, "_slot")
        .agg(F.max_by("_row", F.when(F.col("_side") == 0, F.col("_at"))).alias("_end"))
        .withColumn("_carried", F.last("_end", ignorenulls=True).over(
            W.partitionBy(view.entity).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)))
        .select(view.entity, "_slot", "_carried")
    )
    found = (
        matched.filter(F.col("_side") == 1)
        .join(ends, [view.entity, "_slot"], "left")
        .withColumn("_match", F.coalesce("_match", "_carried"))
    )
    alive = F.col("_match").isNotNull()
    if view.ttl is not None:
        limit = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(view.ttl.total_seconds()))
        alive = alive & (F.col(f"_match.{view.event_time}") + limit >= F.col("_at"))
    return found.select(
        view.entity, F.col("_at").alias(at), *[F.col(f"_keep.{c}").alias(c) for c in keep],
        *[F.when(alive, F.col(f"_match.{c}")).alias(c) for c in payload])
