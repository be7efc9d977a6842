"""Named queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, and for the relational ones a DuckDB twin.

Computed doubles are rounded to 6 places on both sides so the comparison is
about semantics, not summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evaluate, match, sample, shape, sketch, summary
from tessera.operators.features import apply_index, fit_index, standardize, string_index_table
from tessera.plans import frames as fr
from tessera.plans import params as P
from tessera.plans.sqlparts import h_sql, u_sql, with_ctes
from tessera.session import scratch_path
from tessera.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


# --------------------------------------------------------------------------
# Projections and filters
# --------------------------------------------------------------------------

@query("fixed_width", with_ctes("SELECT song_id, track_id FROM line_ids", "line_ids"))
def q_fixed_width(spark, d):
    return fr.line_ids(spark, d)


@query("prefix_filter", with_ctes(
    "SELECT value FROM acc_lines WHERE starts_with(value, '< ERROR: ')", "acc_lines"))
def q_prefix_filter(spark, d):
    return shape.keep_prefix(fx.accepted_lines(spark, d), "value", "< ERROR: ")


@query("strip_quotes", with_ctes("SELECT * FROM feat", "feat"))
def q_strip_quotes(spark, d):
    return fr.features(spark, d)


@query("select_prefixed", with_ctes(
    "SELECT f_lines, f_quantity, f_revenue, f_discount, f_price, f_size FROM feat", "feat"))
def q_select_prefixed(spark, d):
    """The feature columns by their prefix, two of them dropped."""
    return shape.select_prefixed(fr.features(spark, d), "f_", drop=["f_tax", "f_key"])


@query("point_lookup", with_ctes(
    f"SELECT * FROM clean WHERE user_id = '{P.LOOKUP_USER}'", "clean"))
def q_point_lookup(spark, d):
    """P9 on stored facts: the equality is a pushed filter of the scan."""
    path = scratch_path(spark, "facts")
    fr.clean_triplets(spark, d).write.parquet(path)
    return shape.lookup(spark.read.parquet(path), "user_id", P.LOOKUP_USER)


@query("binary_label", with_ctes("SELECT track_id, genre, label FROM binlab", "binlab"))
def q_binary_label(spark, d):
    return fr.binary_labelled(spark, d).select("track_id", "genre", "label")


def _weights_sql() -> str:
    cases = " ".join(
        f"WHEN label IN ({', '.join(_d(float(v)) for v in members)}) THEN {_d(w)}"
        for w, members in P.WEIGHT_BUCKETS.items())
    return f"CASE {cases} ELSE {_d(P.WEIGHT_DEFAULT)} END"


@query("weight_buckets", with_ctes(
    f"SELECT track_id, label, {_weights_sql()} AS weight FROM multi", "multi"))
def q_weight_buckets(spark, d):
    return shape.weight_by_label(fr.multiclass(spark, d), "label", P.WEIGHT_BUCKETS,
                                 P.WEIGHT_DEFAULT).select("track_id", "label", "weight")


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------

@query("effective_exclusions", with_ctes("SELECT song_id, track_id FROM eff", "eff"))
def q_effective_exclusions(spark, d):
    return fr.effective(spark, d)


@query("exclude_keys", with_ctes("SELECT user_id, song_id, play_count FROM clean", "clean"))
def q_exclude_keys(spark, d):
    return fr.clean_triplets(spark, d)


@query("attach_label", with_ctes("SELECT * FROM labelled", "labelled"))
def q_attach_label(spark, d):
    return fr.labelled(spark, d)


@query("reduce_facts", with_ctes("SELECT user_id, song_id, play_count FROM reduced", "reduced"))
def q_reduce_facts(spark, d):
    return fr.reduced(spark, d)


@query("reduce_facts_stats", with_ctes(
    "SELECT r.user_id, r.song_id, r.play_count, s.n_users, s.total_plays AS item_total, "
    "u.n_songs, u.total_plays AS user_total FROM reduced r "
    "JOIN sp s ON r.song_id = s.song_id JOIN ua u ON r.user_id = u.user_id", "reduced", "sp", "ua"))
def q_reduce_facts_stats(spark, d):
    out = fr.reduced(spark, d, keep_stats=True)
    return out.select("user_id", "song_id", "play_count", F.col("item_users").alias("n_users"),
                      "item_total", F.col("user_items").alias("n_songs"), "user_total")


@query("uncovered_keys", with_ctes("SELECT user_id, song_id, play_count FROM unc", "unc"))
def q_uncovered_keys(spark, d):
    s = fr.pin(fr.cold_split(spark, d))
    test = s.where(F.col("split") == "test").drop("split")
    train = s.where(F.col("split") == "train")
    return match.uncovered(test, train, "user_id")


@query("exclude_pairs", with_ctes(
    "SELECT * FROM cold c WHERE split = 'test' AND NOT EXISTS (SELECT 1 FROM repaired r "
    "WHERE r.split = 'train' AND r.user_id = c.user_id AND r.song_id = c.song_id)", "cold", "repaired"))
def q_exclude_pairs(spark, d):
    """The reference's second step of the repair: test rows minus every
    (user, item) pair that is now in training."""
    cold = fr.pin(fr.cold_split(spark, d))
    test = cold.where(F.col("split") == "test")
    moved = fr.repaired(spark, d, cold).where(F.col("split") == "train")
    return match.exclude(test, moved, ["user_id", "song_id"])


@query("union_rows", with_ctes(
    "SELECT song_id, track_id FROM line_ids UNION ALL SELECT song_id, track_id FROM acc", "line_ids", "acc"))
def q_union_rows(spark, d):
    return match.union_rows(fr.line_ids(spark, d), fr.accepted(spark, d))


# --------------------------------------------------------------------------
# Aggregations and statistics
# --------------------------------------------------------------------------

@query("row_counts", with_ctes(
    "SELECT 'triplets' AS name, count(*) AS rows FROM trip UNION ALL "
    "SELECT 'clean', count(*) FROM clean UNION ALL "
    "SELECT 'mismatches', count(*) FROM mis UNION ALL "
    "SELECT 'accepted', count(*) FROM acc UNION ALL "
    "SELECT 'effective', count(*) FROM eff UNION ALL "
    "SELECT 'labels', count(*) FROM genre_ok UNION ALL "
    "SELECT 'labelled', count(*) FROM labelled", "trip", "clean", "mis", "acc", "eff", "genre_ok",
    "labelled"))
def q_row_counts(spark, d):
    return summary.row_counts({
        "triplets": fx.triplets(spark, d), "clean": fr.clean_triplets(spark, d),
        "mismatches": fr.mismatches(spark, d), "accepted": fr.accepted(spark, d),
        "effective": fr.effective(spark, d), "labels": fr.genre_ok(spark, d),
        "labelled": fr.labelled(spark, d)})


@query("class_balance", with_ctes(
    "SELECT label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS ratio "
    "FROM binlab GROUP BY label", "binlab"))
def q_class_balance(spark, d):
    return summary.class_balance(fr.binary_labelled(spark, d), "label").withColumn("ratio", r6("ratio"))


@query("group_counts", with_ctes("SELECT genre, count(*) AS count FROM genre_ok GROUP BY genre",
                                 "genre_ok"))
def q_group_counts(spark, d):
    return summary.group_counts(fr.genre_ok(spark, d), "genre")


@query("user_activity", with_ctes("SELECT * FROM ua", "ua"))
def q_user_activity(spark, d):
    return fr.user_activity(spark, d)


@query("item_popularity", with_ctes("SELECT * FROM sp", "sp"))
def q_item_popularity(spark, d):
    return fr.item_popularity(spark, d)


@query("distinct_counts", with_ctes(
    "SELECT count(DISTINCT song_id) AS song_id, count(DISTINCT user_id) AS user_id FROM clean", "clean"))
def q_distinct_counts(spark, d):
    return summary.distinct_counts(fr.clean_triplets(spark, d), ["song_id", "user_id"])


@query("weight_audit", with_ctes(
    f"SELECT DISTINCT label, {_weights_sql()} AS weight FROM multi", "multi"))
def q_weight_audit(spark, d):
    w = shape.weight_by_label(fr.multiclass(spark, d), "label", P.WEIGHT_BUCKETS, P.WEIGHT_DEFAULT)
    return summary.values_per_group(w, "label", "weight")


_ITEMS_SQL = ("SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, song_id) AS position, "
              "song_id FROM repaired WHERE split = 'test'")


@query("relevant_items", with_ctes(_ITEMS_SQL, "repaired"))
def q_relevant_items(spark, d):
    """The whole ranked list of every user, as rows."""
    test = fr.repaired(spark, d).where(F.col("split") == "test")
    return summary.ranked_items(test, "user_id", "song_id", "play_count")


@query("item_list_lookup", with_ctes(f"SELECT * FROM ({_ITEMS_SQL}) WHERE user_id = '{P.LIST_LOOKUP_USER}'", "repaired"))
def q_item_list_lookup(spark, d):
    """P9 before the list is made: only one user's rows are ranked."""
    test = fr.repaired(spark, d).where(F.col("split") == "test")
    return summary.ranked_items(shape.lookup(test, "user_id", P.LIST_LOOKUP_USER), "user_id", "song_id", "play_count")


def _describe_sql(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, "
             f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
             f"CAST(max({c}) AS DOUBLE) AS max FROM {src}" for c in cols]
    return " UNION ALL ".join(parts)


@query("describe", with_ctes(_describe_sql("ua", ["n_songs", "total_plays"]), "ua"))
def q_describe(spark, d):
    out = summary.describe_long(fr.user_activity(spark, d), ["n_songs", "total_plays"])
    return out.select("column", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"),
                      "min", "max")


@query("describe_items", with_ctes(_describe_sql("sp", ["n_users", "total_plays"]), "sp"))
def q_describe_items(spark, d):
    out = summary.describe_long(fr.item_popularity(spark, d), ["n_users", "total_plays"])
    return out.select("column", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"), "min", "max")


@query("describe_features", with_ctes(_describe_sql("feat", list(fx.FEATURES)), "feat"))
def q_describe_features(spark, d):
    out = summary.describe_long(fr.features(spark, d), list(fx.FEATURES))
    return out.select("column", "count", r6("mean").alias("mean"), r6("stddev").alias("stddev"),
                      "min", "max")


def _quantiles_sql(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column, {_d(p)} AS probability, "
             f"CAST(quantile_disc({c}, {p!r}) AS DOUBLE) AS value FROM {src}"
             for c in cols for p in P.QUANTILE_PROBS]
    return " UNION ALL ".join(parts)


@query("quantiles", with_ctes(_quantiles_sql("ua", ["n_songs", "total_plays"]), "ua"))
def q_quantiles(spark, d):
    return summary.quantiles(fr.user_activity(spark, d), ["n_songs", "total_plays"],
                             P.QUANTILE_PROBS, 0.0)


@query("item_quantiles", with_ctes(_quantiles_sql("sp", ["n_users", "total_plays"]), "sp"))
def q_item_quantiles(spark, d):
    return summary.quantiles(fr.item_popularity(spark, d), ["n_users", "total_plays"],
                             P.QUANTILE_PROBS, 0.0)


@query("quantiles_approx")
def q_quantiles_approx(spark, d):
    """A9 with the reference's relative error 0.05 (Greenwald-Khanna sketch,
    bounded memory): values are within 5% of the rank of the exact ones, so
    this has no exact SQL twin; ``quantiles`` is the exact form."""
    return summary.quantiles(fr.user_activity(spark, d), ["n_songs", "total_plays"],
                             P.QUANTILE_PROBS, P.QUANTILE_REL_ERR)


_WITHIN_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, {_d(p)} AS probability, count({c}) AS n, true AS within FROM ua"
    for c in ("n_songs", "total_plays") for p in P.QUANTILE_PROBS)


@query("quantile_sketches", with_ctes(_WITHIN_SQL, "ua"))
def q_quantile_sketches(spark, d):
    """A9 from stored states: a KLL sketch per part of the users, written, read
    again and merged; each value's exact rank interval is counted in the data
    and must come within the tolerance of the probability asked for."""
    cols = ["n_songs", "total_plays"]
    users = fr.pin(fr.user_activity(spark, d).withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(P.STATE_PARTS))))
    path = scratch_path(spark, "quantile-state")
    sketch.quantile_state(users, cols, ["part"]).write.parquet(path)
    found = sketch.merged_quantiles(spark.read.parquet(path), P.QUANTILE_PROBS)
    return sketch.rank_audit(found, users, P.QUANTILE_REL_ERR).select("column", "probability", "n", "within")


_DISTINCT_SQL = """
    WITH keys AS (SELECT o_custkey, l_partkey, CAST(year(o_orderdate) AS INTEGER) AS year
                  FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
    counts AS (SELECT year, count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT l_partkey) AS l_partkey
               FROM keys GROUP BY GROUPING SETS ((year), ()))
    SELECT 'o_custkey' AS column, year, o_custkey AS "distinct" FROM counts
    UNION ALL SELECT 'l_partkey', year, l_partkey FROM counts"""


def _monthly_keys(spark, d) -> DataFrame:
    """Keys of buyers and parts per month of the order."""
    lines = fx.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.trunc("o_orderdate", "month").alias("month"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("month", "o_custkey", "l_partkey")


def _yearly(state: DataFrame, counts) -> DataFrame:
    """Counts per year and, with a null year, over all parts of a state."""
    years = state.withColumn("year", F.year("month"))
    return counts(years, ["year"]).unionByName(counts(years, []).withColumn("year", F.lit(None).cast("int")))


@query("distinct_bitmaps", _DISTINCT_SQL)
def q_distinct_bitmaps(spark, d):
    """A5 from stored monthly bitmaps, merged to years and to the whole: exact."""
    path = scratch_path(spark, "distinct-bitmaps")
    sketch.distinct_bitmaps(_monthly_keys(spark, d), ["o_custkey", "l_partkey"], ["month"]).write.parquet(path)
    return _yearly(spark.read.parquet(path), sketch.bitmap_counts).select("column", "year", "distinct")


@query("distinct_sketches", f'SELECT "column", year, true AS within FROM ({_DISTINCT_SQL})')
def q_distinct_sketches(spark, d):
    """A5 from stored monthly HyperLogLog states; each merged estimate is held
    against the exact count of the merged bitmaps."""
    keys, cols, path = fr.pin(_monthly_keys(spark, d)), ["o_custkey", "l_partkey"], scratch_path(spark, "distinct-sketches")
    sketch.distinct_sketches(keys, cols, ["month"]).write.parquet(path)
    exact = _yearly(sketch.distinct_bitmaps(keys, cols, ["month"]), sketch.bitmap_counts).withColumnRenamed("distinct", "exact")
    about = _yearly(spark.read.parquet(path), sketch.sketch_counts)
    same = (about["column"] == exact["column"]) & about["year"].eqNullSafe(exact["year"])
    within = sketch.close_to(F.col("distinct"), F.col("exact"), sketch.sketch_bound())
    return about.join(exact, same).select(about["column"], about["year"], within.alias("within"))


def _corr_sql(where: str = "") -> str:
    cols = list(fx.FEATURES)
    parts = [f"SELECT {i} AS i, {j} AS j, '{cols[i]}' AS col_i, '{cols[j]}' AS col_j, "
             f"round(corr({cols[i]}, {cols[j]}), 6) AS r FROM feat"
             for i in range(len(cols)) for j in range(i + 1, len(cols))]
    body = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) {where}"


@query("correlation", with_ctes(_corr_sql(), "feat"))
def q_correlation(spark, d):
    return summary.correlation_pairs(fr.features(spark, d), list(fx.FEATURES)).withColumn("r", r6("r"))


@query("correlated_pairs", with_ctes(_corr_sql(f"WHERE r > {P.CORR_THRESHOLD}"), "feat"))
def q_correlated_pairs(spark, d):
    out = summary.correlated_pairs(fr.features(spark, d), list(fx.FEATURES), P.CORR_THRESHOLD)
    return out.withColumn("r", r6("r")).where(F.col("r") > P.CORR_THRESHOLD)


def _decorrelate_sql() -> str:
    """The greedy rule over columns in order: a column is kept unless a kept
    earlier one correlates with it."""
    cols = ", ".join(f"({i}, '{c}')" for i, c in enumerate(fx.FEATURES))
    ctes = with_ctes("", "feat").rstrip().replace("WITH ", "WITH RECURSIVE ", 1)
    return (f"{ctes}, pairs AS ({_corr_sql(f'WHERE r > {P.CORR_THRESHOLD}')}), "
            f"cols(k, name) AS (VALUES {cols}), "
            "walk(k, kept) AS (SELECT 0, CAST([] AS INTEGER[]) UNION ALL SELECT k + 1, CASE WHEN EXISTS "
            "(SELECT 1 FROM pairs p WHERE p.j = walk.k AND list_contains(walk.kept, p.i)) THEN kept "
            f"ELSE list_append(kept, k) END FROM walk WHERE k < {len(fx.FEATURES)}) "
            "SELECT name AS column, list_contains((SELECT kept FROM walk ORDER BY k DESC LIMIT 1), k) AS kept FROM cols")


@query("decorrelate", _decorrelate_sql())
def q_decorrelate(spark, d):
    return summary.kept_columns(fr.features(spark, d), list(fx.FEATURES), P.CORR_THRESHOLD)


@query("retention", with_ctes(
    "SELECT (SELECT count(*) FROM clean) AS before, (SELECT count(*) FROM reduced) AS after, "
    "round((SELECT count(*) FROM reduced) / (SELECT count(*) FROM clean), 6) AS ratio",
    "clean", "reduced"))
def q_retention(spark, d):
    facts = fr.pin(fr.clean_triplets(spark, d))
    out = summary.retention(facts, fr.reduced(spark, d, facts))
    return out.withColumn("ratio", r6("ratio"))


@query("histogram", with_ctes(
    f"SELECT CAST(floor(total_plays / {_d(P.HISTOGRAM_WIDTH)}) * {_d(P.HISTOGRAM_WIDTH)} AS DOUBLE) "
    "AS bin_start, count(*) AS count FROM sp GROUP BY 1", "sp"))
def q_histogram(spark, d):
    return summary.histogram(fr.item_popularity(spark, d), "total_plays", P.HISTOGRAM_WIDTH)


@query("distinct_values", with_ctes("SELECT DISTINCT genre FROM genre_ok", "genre_ok"))
def q_distinct_values(spark, d):
    return summary.distinct_values(fr.genre_ok(spark, d), "genre")


_ORDERED_SQL = ("SELECT user_id, song_id, weight, row_number() OVER (ORDER BY user_id ASC NULLS LAST, weight DESC NULLS LAST, "
                "song_id ASC NULLS LAST) AS position FROM (SELECT user_id, song_id, nullif(play_count % 7, 0) AS weight FROM clean)")


@query("ordered_rows", with_ctes(_ORDERED_SQL, "clean"))
def q_ordered_rows(spark, d):
    """O3: a multi-key sort with explicit nulls, and each row's place in it."""
    rows = fr.clean_triplets(spark, d).select("user_id", "song_id", F.nullif(F.col("play_count") % 7, F.lit(0)).alias("weight"))
    ordered = summary.order_rows(rows, F.col("user_id").asc_nulls_last(), F.col("weight").desc_nulls_last(), F.col("song_id").asc_nulls_last())
    return summary.positions(ordered)


@query("top_rows", with_ctes(
    f"SELECT * FROM clean ORDER BY play_count DESC, user_id, song_id LIMIT {P.TOP_ROWS_N}", "clean"))
def q_top_rows(spark, d):
    return summary.top_rows(fr.clean_triplets(spark, d), "play_count", P.TOP_ROWS_N,
                            ["user_id", "song_id"])


@query("top_k_per_group", with_ctes(
    "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, "
    f"song_id) AS INTEGER) AS rank FROM clean) WHERE rank <= {P.TOP_PER_USER}", "clean"))
def q_top_k_per_group(spark, d):
    return summary.top_k_per_group(fr.clean_triplets(spark, d), "user_id",
                                   [F.col("play_count").desc(), F.col("song_id")], P.TOP_PER_USER,
                                   rank_col="rank")


@query("top_k_items", with_ctes(
    "SELECT user_id, list(song_id ORDER BY play_count DESC, song_id) AS items FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, song_id) AS rn "
    f"FROM repaired WHERE split = 'train') WHERE rn <= {P.RECOMMEND_K} GROUP BY user_id", "repaired"))
def q_top_k_items(spark, d):
    """O5 on score lists: each user's best ``k`` training items as (item, rating)
    structs, cut to ``k`` before they are grouped, and ordered."""
    from tessera.functions.columns import top_k_by_score
    train = fr.repaired(spark, d).where(F.col("split") == "train")
    top = summary.top_k_per_group(train, "user_id", [F.col("play_count").desc(), F.col("song_id")],
                                  P.RECOMMEND_K)
    lists = top.groupBy("user_id").agg(F.collect_list(F.struct(
        F.col("song_id").alias("item"), F.col("play_count").cast("float").alias("rating"))).alias("recs"))
    return lists.select("user_id", top_k_by_score("recs", P.RECOMMEND_K).alias("items"))


# --------------------------------------------------------------------------
# Sampling, splitting, windows
# --------------------------------------------------------------------------

@query("stratified_split", with_ctes("SELECT track_id, label, split FROM strat", "strat"))
def q_stratified_split(spark, d):
    return fr.stratified(spark, d).select("track_id", "label", "split")


@query("stratified_balance", with_ctes(
    "SELECT split, label, count(*) AS count FROM strat GROUP BY split, label", "strat"))
def q_stratified_balance(spark, d):
    return fr.stratified(spark, d).groupBy("split", "label").agg(F.count(F.lit(1)).alias("count"))


def _balance_sql(src: str) -> str:
    return (f"SELECT label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS ratio FROM ({src}) GROUP BY label")


def _balance(df: DataFrame) -> DataFrame:
    return summary.class_balance(df, "label").withColumn("ratio", r6("ratio"))


@query("balance_train", with_ctes(_balance_sql("SELECT label FROM strat WHERE split = 'train'"), "strat"))
def q_balance_train(spark, d):
    return _balance(fr.pin(fr.stratified(spark, d)).where(F.col("split") == "train"))


@query("balance_test", with_ctes(_balance_sql("SELECT label FROM strat WHERE split = 'test'"), "strat"))
def q_balance_test(spark, d):
    return _balance(fr.pin(fr.stratified(spark, d)).where(F.col("split") == "test"))


def _numbered_sql(src: str, by: str, ids: list[str], extra: str) -> str:
    return (f"SELECT {extra}, row_number() OVER (PARTITION BY {by} ORDER BY {h_sql(ids, P.SAMPLE_SEED)}) AS row, "
            f"count(*) OVER (PARTITION BY {by}) AS size FROM {src}")


@query("number_strata", with_ctes(_numbered_sql("binlab", "label", ["track_id"], "track_id, label"), "binlab"))
def q_number_strata(spark, d):
    """Random-order row number and size inside label strata."""
    rows = fr.pin(fr.binary_labelled(spark, d).select("track_id", "label"))
    return sample.numbered(rows, ["label"], ["track_id"], P.SAMPLE_SEED)


@query("number_users", with_ctes(_numbered_sql("clean", "user_id", ["user_id", "song_id"], "user_id, song_id"), "clean"))
def q_number_users(spark, d):
    """The same inside users."""
    rows = fr.pin(fr.clean_triplets(spark, d).select("user_id", "song_id"))
    return sample.numbered(rows, ["user_id"], ["user_id", "song_id"], P.SAMPLE_SEED)


@query("random_split", with_ctes("SELECT * FROM splitted", "splitted"))
def q_random_split(spark, d):
    return fr.splitted(spark, d)


_DOWN_SQL = ("SELECT track_id, label FROM strat WHERE split = 'train' AND (label <> 0 OR (label = 0 AND "
             f"{u_sql(['track_id'], P.SAMPLE_SEED)} < "
             f"(SELECT avg(label) * {_d(P.DOWNSAMPLE_FACTOR)} FROM strat WHERE split = 'train')))")
_UP_SQL = ("SELECT track_id, label FROM strat WHERE split = 'train' AND label = 0 UNION ALL "
           f"SELECT s.track_id, s.label FROM strat s, range(1, {P.UPSAMPLE_N + 1}) r(i) WHERE s.split = 'train' "
           f"AND s.label = 1 AND {u_sql(['track_id', 'i'], P.SAMPLE_SEED)} > {_d(P.UPSAMPLE_P)}")


def _train(spark, d) -> DataFrame:
    return fr.pin(fr.stratified(spark, d)).where(F.col("split") == "train")


def _downsampled(train: DataFrame) -> DataFrame:
    """The rate follows from the balance of ``train``, which should be pinned."""
    rate = train.select(F.avg("label") * F.lit(P.DOWNSAMPLE_FACTOR)).scalar()
    return sample.downsample(train, "label", 0, rate, ["track_id"], P.SAMPLE_SEED)


def _upsampled(train: DataFrame) -> DataFrame:
    return sample.upsample(train, "label", 1, 0, P.UPSAMPLE_N, P.UPSAMPLE_P, ["track_id"], P.SAMPLE_SEED)


@query("downsample", with_ctes(_DOWN_SQL, "strat"))
def q_downsample(spark, d):
    return _downsampled(_train(spark, d)).select("track_id", "label")


@query("balance_downsampled", with_ctes(_balance_sql(_DOWN_SQL), "strat"))
def q_balance_downsampled(spark, d):
    return _balance(fr.pin(_downsampled(_train(spark, d)).select("label")))


@query("upsample", with_ctes(_UP_SQL, "strat"))
def q_upsample(spark, d):
    return _upsampled(_train(spark, d)).select("track_id", "label")


@query("balance_upsampled", with_ctes(_balance_sql(_UP_SQL), "strat"))
def q_balance_upsampled(spark, d):
    return _balance(fr.pin(_upsampled(_train(spark, d)).select("label")))


@query("repair_coverage", with_ctes("SELECT * FROM repaired", "repaired"))
def q_repair_coverage(spark, d):
    return fr.repaired(spark, d)


@query("coverage_report", with_ctes(
    "SELECT split, count(*) AS rows, count(DISTINCT user_id) AS users FROM repaired GROUP BY split",
    "repaired"))
def q_coverage_report(spark, d):
    return (fr.repaired(spark, d).groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users")))


# --------------------------------------------------------------------------
# Feature preparation
# --------------------------------------------------------------------------

def _standardize_sql() -> str:
    cols = list(fx.FEATURES)
    exprs = ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER () IS NULL OR stddev_samp({c}) OVER () = 0 THEN 0.0 "
        f"ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END, 6) AS {c}" for c in cols)
    return with_ctes(f"SELECT track_id, {exprs} FROM feat", "feat")


@query("standardize", _standardize_sql())
def q_standardize(spark, d):
    feats = fr.pin(fr.features(spark, d))  # read for the statistics and for the rows
    out = standardize(feats, list(fx.FEATURES))
    return out.select("track_id", *[r6(c).alias(c) for c in fx.FEATURES])


@query("string_index", with_ctes(
    "SELECT user_id, count(*) AS frequency, "
    "CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS DOUBLE) AS index "
    "FROM reduced GROUP BY user_id", "reduced"))
def q_string_index(spark, d):
    return string_index_table(fr.reduced(spark, d), "user_id", "index")


@query("genre_index", with_ctes("SELECT track_id, genre, label FROM multi", "multi"))
def q_genre_index(spark, d):
    return fr.multiclass(spark, d).select("track_id", "genre", "label")


_VOCAB_SQL = ("SELECT c.user_id, c.song_id, {index} AS index FROM cold c {join} JOIN (SELECT user_id, CAST(row_number() OVER "
              "(ORDER BY count(*) DESC, user_id) - 1 AS DOUBLE) AS index FROM cold WHERE split = 'train' GROUP BY user_id) v "
              "ON c.user_id = v.user_id WHERE c.split = 'test'")
_VOCAB_SIZE_SQL = "(SELECT CAST(count(DISTINCT user_id) AS DOUBLE) FROM cold WHERE split = 'train')"


def _indexed_test(spark, d, unseen: str) -> DataFrame:
    """the vocabulary of the training users applied to test rows, some of
    whose users were never trained on."""
    cold = fr.pin(fr.cold_split(spark, d))
    vocab = fit_index(cold.where(F.col("split") == "train"), "user_id")
    return apply_index(cold.where(F.col("split") == "test").select("user_id", "song_id"), vocab, "user_id", "index", unseen)


@query("index_skip", with_ctes(_VOCAB_SQL.format(index="v.index", join=""), "cold"))
def q_index_skip(spark, d):
    return _indexed_test(spark, d, "skip")


@query("index_keep", with_ctes(_VOCAB_SQL.format(index=f"coalesce(v.index, {_VOCAB_SIZE_SQL})", join="LEFT"), "cold"))
def q_index_keep(spark, d):
    return _indexed_test(spark, d, "keep")


# --------------------------------------------------------------------------
# Evaluation on fixed predictions
# --------------------------------------------------------------------------

def _binary_sql(src: str, pred: str, group: str = "", select_extra: str = "") -> str:
    return (
        f"SELECT {select_extra}count(*) AS total, count(*) FILTER (WHERE label = 1) AS positive, "
        "count(*) FILTER (WHERE label = 0) AS negative, "
        f"count(*) FILTER (WHERE {pred} = 1) AS n_pred_pos, count(*) FILTER (WHERE {pred} = 0) AS n_pred_neg, "
        f"count(*) FILTER (WHERE {pred} = 1 AND label = 1) AS tp, "
        f"count(*) FILTER (WHERE {pred} = 1 AND label = 0) AS fp, "
        f"count(*) FILTER (WHERE {pred} = 0 AND label = 1) AS fn, "
        f"count(*) FILTER (WHERE {pred} = 0 AND label = 0) AS tn, "
        f"round(CAST(count(*) FILTER (WHERE {pred} = 1 AND label = 1) AS DOUBLE) / "
        f"nullif(count(*) FILTER (WHERE {pred} = 1), 0), 6) AS precision, "
        f"round(CAST(count(*) FILTER (WHERE {pred} = 1 AND label = 1) AS DOUBLE) / "
        f"nullif(count(*) FILTER (WHERE label = 1), 0), 6) AS recall, "
        f"round(CAST(count(*) FILTER (WHERE {pred} = label) AS DOUBLE) / nullif(count(*), 0), 6) "
        f"AS accuracy FROM {src} {group}")


def _round_report(df: DataFrame) -> DataFrame:
    return (df.withColumn("precision", r6("precision")).withColumn("recall", r6("recall"))
            .withColumn("accuracy", r6("accuracy")))


@query("binary_report", with_ctes(
    _binary_sql("(SELECT label, CAST(score > 0.5 AS INTEGER) AS prediction FROM scored)", "prediction"),
    "scored"))
def q_binary_report(spark, d):
    s = fr.scored(spark, d)
    preds = evaluate.apply_threshold(s, "score", 0.5, "prediction")
    return _round_report(evaluate.binary_report(preds, "label", "prediction"))


@query("threshold_sweep", with_ctes(
    _binary_sql(f"(SELECT label, score, t AS threshold, CAST(score > t AS INTEGER) AS p FROM scored, "
                f"(SELECT unnest([{', '.join(_d(t) for t in P.SWEEP_THRESHOLDS)}]) AS t))",
                "p", "GROUP BY threshold", "threshold, "), "scored"))
def q_threshold_sweep(spark, d):
    out = evaluate.threshold_sweep(fr.scored(spark, d), "score", P.SWEEP_THRESHOLDS, "label")
    return _round_report(out)


@query("auroc", with_ctes(
    "SELECT round(sum(pos * (cneg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auroc, "
    "CAST(sum(pos) AS BIGINT) AS positive, CAST(sum(neg) AS BIGINT) AS negative, "
    "(SELECT count(*) FROM scored WHERE score IS NULL OR label IS NULL OR label NOT IN (0, 1)) AS left_out FROM ("
    "SELECT score, pos, neg, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    "AS cneg FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, "
    "count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score))", "scored"))
def q_auroc(spark, d):
    return evaluate.auroc(fr.scored(spark, d), "label", "score").withColumn("auroc", r6("auroc"))


@query("per_class_report", with_ctes(
    "SELECT class, tp, predicted, actual, "
    "round(CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END, 6) AS precision, "
    "round(CAST(tp AS DOUBLE) / nullif(actual, 0), 6) AS recall FROM ("
    "SELECT c.class, "
    "(SELECT count(*) FROM mscored m WHERE m.label = c.class AND m.prediction = c.class) AS tp, "
    "(SELECT count(*) FROM mscored m WHERE m.prediction = c.class) AS predicted, "
    "(SELECT count(*) FROM mscored m WHERE m.label = c.class) AS actual "
    "FROM (SELECT label AS class FROM mscored UNION SELECT prediction FROM mscored) c)", "mscored"))
def q_per_class_report(spark, d):
    out = evaluate.per_class_report(fr.multi_scored(spark, d), "label", "prediction")
    return out.withColumn("precision", r6("precision")).withColumn("recall", r6("recall"))


def _popular_lists(spark, d) -> tuple[DataFrame, DataFrame]:
    """Popularity baseline: every training user gets the ``RECOMMEND_K`` songs
    with the most training plays (ties by id). The list is a scalar subquery
    of ``k`` items, so it is attached to users without a join."""
    rep = fr.repaired_pinned(spark, d)
    train = rep.where(F.col("split") == "train")
    truth = rep.where(F.col("split") == "test").select("user_id", "song_id")
    totals = train.groupBy("song_id").agg(F.sum("play_count").alias("t"))
    top = summary.top_rows(totals, "t", P.RECOMMEND_K, ["song_id"])
    lst = top.agg(F.array_sort(F.collect_list(F.struct(F.negative("t").alias("nt"), "song_id")))
                  .alias("l")).select(F.transform("l", lambda z: z["song_id"]).alias("items")).scalar()
    users = train.select("user_id").distinct().select("user_id", lst.alias("items"))
    return users, truth


def _ranking_sql() -> str:
    return with_ctes(
        "SELECT count(*) AS users, round(avg(hits_k / " + _d(float(P.RANKING_K)) + "), 6) AS precision_at_k, "
        "round(avg(dcg / idcg), 6) AS ndcg_at_k, round(avg(ap / nrel), 6) AS mean_average_precision FROM ("
        "SELECT u.user_id, coalesce(h.hits_k, 0) AS hits_k, coalesce(h.dcg, 0.0) AS dcg, "
        "coalesce(h.ap, 0.0) AS ap, s.nrel, "
        f"(SELECT sum(1.0 / ln(g + 2)) FROM range(0, least(s.nrel, {P.RANKING_K})) t(g)) AS idcg "
        "FROM (SELECT DISTINCT user_id FROM repaired WHERE split = 'train') u "
        "JOIN (SELECT user_id, count(*) AS nrel FROM repaired WHERE split = 'test' GROUP BY user_id) s "
        "ON u.user_id = s.user_id LEFT JOIN ("
        f"SELECT user_id, count(*) FILTER (WHERE hit = 1 AND pos < {P.RANKING_K}) AS hits_k, "
        f"sum(CASE WHEN hit = 1 AND pos < {P.RANKING_K} THEN 1.0 / ln(pos + 2) ELSE 0.0 END) AS dcg, "
        "sum(CASE WHEN hit = 1 THEN cum / (pos + 1.0) ELSE 0.0 END) AS ap FROM ("
        "SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY pos) AS cum FROM ("
        "SELECT u2.user_id, p.pos, CASE WHEN EXISTS (SELECT 1 FROM repaired r WHERE r.split = 'test' "
        "AND r.user_id = u2.user_id AND r.song_id = p.song_id) THEN 1 ELSE 0 END AS hit "
        "FROM (SELECT DISTINCT user_id FROM repaired WHERE split = 'train') u2, "
        "(SELECT song_id, row_number() OVER (ORDER BY t DESC, song_id) - 1 AS pos FROM ("
        "SELECT song_id, sum(play_count) AS t FROM repaired WHERE split = 'train' GROUP BY song_id) "
        f"ORDER BY t DESC, song_id LIMIT {P.RECOMMEND_K}) p)) GROUP BY user_id) h "
        "ON u.user_id = h.user_id)", "repaired")


@query("ranking_report", _ranking_sql())
def q_ranking_report(spark, d):
    users, truth = _popular_lists(spark, d)
    out = evaluate.ranking_report(users, truth, "user_id", "song_id", "items", P.RANKING_K)
    return out.select("users", r6("precision_at_k").alias("precision_at_k"),
                      r6("ndcg_at_k").alias("ndcg_at_k"),
                      r6("mean_average_precision").alias("mean_average_precision"))


def all_queries() -> dict[str, Query]:
    from tessera.plans import mlqueries, ioqueries  # noqa: F401  (registers more)
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    all_queries()
    return dict(ORACLE)
