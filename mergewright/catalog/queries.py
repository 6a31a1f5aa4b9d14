"""One registered query per operator. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergewright.catalog.sources_sql import RAW_A, RAW_B
from mergewright.functions import (
    block_text,
    clean_vin,
    mileage_bin,
    norm_block,
    norm_compare,
    norm_linker,
    nulls_in_frame,
    to_number,
)
from mergewright.functions.similarity import exact, jaro_winkler_at_least, linear
from mergewright.operators import (
    assign,
    blocking,
    candidates,
    compare,
    dedup,
    mediate,
    metrics,
    models,
    pairs,
    profile,
    quantiles,
    ranking,
    sampling,
    split,
)
from mergewright.operators.blocking import B1, B2
from mergewright.plans import classification, labelling, linkage
from mergewright.schema import (
    MEDIATED,
    MODEL_SIMILARITY_THRESHOLD,
    PROFILED_DISTINCT,
    PROFILED_NUMERIC,
    SOURCE_A,
    SOURCE_B,
)
from mergewright.sources import (
    scan_text,
    scan_typed,
    spread,
    stage,
    write_csv,
    write_json,
    write_splits,
)
from mergewright.sources.keyed import KeyedTable
from mergewright.sources.staging import new_path

# Order of the rows of either source: the position, ties by id.
ORDER = ("pos", "id")
# Cap per label of the capped query; below what the tables give, so that it cuts.
CAP = 1_500
# Weights of the fixed classifier, so that scores do not depend on a fit.
FIXED_WEIGHTS = {"model": 1.5, "year": 2.0, "mileage": 3.0, "state": 0.7, "make": 0.8}
FIXED_INTERCEPT = -6.75


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_a(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(RAW_A.replace("from lineitem join part", "from {lineitem} join {part}"),
                     lineitem=spread(table(spark, folder, "lineitem"), "l_orderkey"),
                     part=table(spark, folder, "part"))


def raw_b(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(RAW_B.replace("from part", "from {part}"), part=table(spark, folder, "part"))


def mediated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return labelling.mediated_sources(raw_a(spark, folder), raw_b(spark, folder), ["pos"])


def gt(spark: SparkSession, folder: str, strategy=B1, **options) -> DataFrame:
    return pairs.label_pairs(*mediated(spark, folder), strategy, ORDER, ORDER, **options)


def fixed_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.predict(compare.pair_features(gt(spark, folder), "label"),
                          FIXED_WEIGHTS, FIXED_INTERCEPT)


def staged_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scored pairs written once, for readers that go through them more than once or filter them: a filter scores each pair again."""
    return stage(fixed_scores(spark, folder).select("id_A", "id_B", "label", "prediction", "score"), "scored")


# Scans and sinks --------------------------------------------------------------------------------

def scan_text_na(spark, folder):
    raw = raw_b(spark, folder).drop("pos")
    path = write_csv(raw, new_path(spark, "csv"))
    return scan_text(spark, path, raw.columns, multiline=True)


def scan_quoted(spark, folder):
    """The small source landed as one quoted file with line breaks in cells, read by byte ranges."""
    raw = raw_b(spark, folder).withColumn("description", F.concat("description", F.lit("\nsecond line, of "), "id")).drop("pos")
    path = write_csv(raw.coalesce(1), new_path(spark, "csv"))
    return scan_text(spark, path, raw.columns, multiline=True)


def scan_typed_orders(spark, folder):
    orders = table(spark, folder, "orders")
    return scan_typed(spark, write_csv(orders, new_path(spark, "csv")), orders.schema)


def scan_inferred(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return scan_typed(spark, write_csv(orders, new_path(spark, "csv")))


def sink_roundtrip(spark, folder):
    b = mediated(spark, folder)[1].drop("pos")
    return scan_typed(spark, write_csv(b, new_path(spark, "csv")), b.schema, multiline=True)


def sink_partitioned(spark, folder):
    path = new_path(spark, "splits")
    write_splits(split_of(spark, folder, B2), path)
    return split.split_sizes(spark.read.parquet(path))


# Projections ------------------------------------------------------------------------------------

def mediate_a(spark, folder):
    return mediated(spark, folder)[0].drop("pos")


def mediate_b(spark, folder):
    return mediated(spark, folder)[1].drop("pos")


def mediate_absent(spark, folder):
    bare = nulls_in_frame(raw_a(spark, folder)).drop("price", "fuel_type", "description")
    return mediate.mediate(bare, SOURCE_A)


def drop_leakage(spark, folder):
    return mediate.drop_leakage(nulls_in_frame(raw_b(spark, folder)))


def preview(spark, folder):
    b = mediated(spark, folder)[1]
    return b.orderBy("pos", "id").limit(10).drop("pos")


# Scalar functions -------------------------------------------------------------------------------

def to_number_query(spark, folder):
    return raw_b(spark, folder).select("id", to_number(F.col("price")).alias("price"),
                                       to_number(F.col("year")).alias("year"),
                                       to_number(F.col("model")).alias("model"))


def on_documents(function):
    def query(spark, folder):
        return spread(table(spark, folder, "documents"), "doc_id").select(
            "doc_id", function(F.col("text")).alias("normal"))
    return query


def on_pages(function):
    def query(spark, folder):
        return spread(table(spark, folder, "pages"), "page_id").select(
            "page_id", function(F.col("url")).alias("url"), function(F.col("html")).alias("html"))
    return query


def clean_key17(spark, folder):
    return raw_b(spark, folder).select("id", clean_vin(F.col("VIN")).alias("vin_clean"))


def mileage_bin_query(spark, folder):
    return raw_a(spark, folder).select(
        "listing_id", mileage_bin(to_number(F.col("mileage"))).alias("bin"),
        mileage_bin(to_number(F.col("horsepower"))).alias("power_bin"))


def block_key(strategy):
    def query(spark, folder):
        keyed = blocking.with_block(mediated(spark, folder)[1], strategy)
        return keyed.select("id", *strategy.columns,
                            blocking.block_label(strategy).alias("block"))
    return query


def block_text_drop(spark, folder):
    a = mediated(spark, folder)[0]
    return a.select("id", block_text(F.col("make"), "drop").alias("make"),
                    block_text(F.col("model"), "drop").alias("model"))


# Pairs ------------------------------------------------------------------------------------------

def gt_b1(spark, folder):
    return gt(spark, folder, B1)


def gt_b2(spark, folder):
    return gt(spark, folder, B2)


def gt_capped(spark, folder):
    return gt(spark, folder, B1, cap=CAP)


def gt_positives(spark, folder):
    a, b = pairs.sides(*mediated(spark, folder), ORDER, ORDER)
    return pairs.positives(a, b).select("id_A", "id_B", F.col("vin_A").alias("vin"))


def gt_negatives(spark, folder):
    a, b = mediated(spark, folder)
    counted = blocking.with_block(a, B2).select(*B2.columns)
    return pairs.negatives(*pairs.sides(a, b, ORDER, ORDER), B2, counted=counted).select(
        "id_A", "id_B", "vin_A", "vin_B")


def gt_drop_missing(spark, folder):
    return gt(spark, folder, B1, null_block="drop").select("id_A", "id_B", "label")


def topk_block(spark, folder):
    b = blocking.with_block(mediated(spark, folder)[1], B1)
    return blocking.first_per_block(b, ["block_make"], ORDER).select(
        "block_make", "id", "block_rank")


def dedup_vin(keep, side):
    def query(spark, folder):
        source = mediated(spark, folder)[side]
        return dedup.one_per_vin(source, ORDER, keep).select("id", "vin_clean", "price", "mileage")
    return query


def upsert_chunks(spark, folder):
    """The small source brought into a stored table by VIN in three chunks, in the order of its rows; the last row counts."""
    b = mediated(spark, folder)[1].withColumn("vin_clean", clean_vin(F.col("vin"))).filter("vin_clean is not null")
    rows = stage(b.select("pos", "id", "vin_clean", "price", "mileage"), "upsert-rows")
    kept = KeyedTable(new_path(spark, "by-vin"), ("vin_clean",), buckets=8)
    last = rows.agg(F.max("pos")).first()[0] or 0
    for chunk in range(3):
        kept.upsert(rows.filter(F.floor(F.col("pos") * 3 / F.lit(last + 1)) == chunk), ORDER)
    return kept.read(spark, rows).select("id", "vin_clean", "price", "mileage")


def records_from_pairs(spark, folder):
    return pairs.records_from_pairs(mediate.drop_leakage(gt(spark, folder)).drop("label"))


def records_for_linker(spark, folder):
    return pairs.records_for_linker(mediate.drop_leakage(gt(spark, folder)).drop("label"))


def label_sample(spark, folder):
    return pairs.label_sample(gt(spark, folder), 10).select("id_A", "id_B", "label", "model_A")


def semi_ids(spark, folder):
    a, _ = mediated(spark, folder)
    links = pairs.true_links(gt(spark, folder))
    return a.select("id", "make", "model").join(links.select(F.col("id_A").alias("id")), "id",
                                                "left_semi")


def anti_pairs(spark, folder):
    b2 = gt(spark, folder, B2).select("id_A", "id_B")
    return dedup.links(gt(spark, folder)).join(b2, ["id_A", "id_B"], "left_anti")


# Profiles ---------------------------------------------------------------------------------------

def profile_missing(spark, folder):
    return profile.missing_counts(nulls_in_frame(raw_a(spark, folder)).drop("pos"))


def profile_distinct(spark, folder):
    return profile.distinct_counts(nulls_in_frame(raw_a(spark, folder)).drop("pos"))


def profile_summary(spark, folder):
    return profile.profile_summary(nulls_in_frame(raw_a(spark, folder)).drop("pos"),
                                   PROFILED_DISTINCT)


def profile_top(spark, folder):
    return profile.profile_top(profile.missing_counts(
        nulls_in_frame(raw_b(spark, folder)).drop("pos")))


def profile_approx(spark, folder):
    b = mediated(spark, folder)[1].drop("pos")
    near = profile.approx_distinct_counts(b).withColumnRenamed("unique_count", "near")
    both = near.join(profile.distinct_counts(b), "attribute")
    close = F.abs(F.col("near") - F.col("unique_count")) <= 0.05 * F.col("unique_count")
    return both.select("attribute", "missing_count", "unique_count", close.alias("within_bound"))


def profile_merge(spark, folder):
    orders = table(spark, folder, "orders")
    parts = stage(profile.partial_profile(
        orders, ["o_orderpriority", "o_orderstatus"],
        ["o_custkey", "o_totalprice"]), "profiles")
    exact_counts = profile.distinct_counts(orders, ["o_custkey", "o_totalprice"])
    whole = profile.merge_profiles(parts).withColumnRenamed("unique_count", "near")
    close = F.abs(F.col("near") - F.col("unique_count")) <= 0.05 * F.col("unique_count")
    return whole.join(exact_counts, "attribute").select(
        "attribute", "missing_count", "count", *[F.round(c, 3).alias(c) for c in (
            "mean", "std", "min", "max")], close.alias("within_bound"))


def profile_states(spark, folder):
    """Orders profiled as three parts, one of them first by mistake with half its rows; its second state replaces the first."""
    orders, path = table(spark, folder, "orders"), new_path(spark, "profile-states")
    part = F.pmod(F.col("o_orderkey"), F.lit(3))
    halved = orders.filter((part == 1) & (F.col("o_custkey") % 2 == 0))
    for name, rows in (("0", orders.filter(part == 0)), ("1", halved), ("2", orders.filter(part == 2)), ("1", orders.filter(part == 1))):
        profile.keep_state(rows, path, name, ["o_custkey", "o_totalprice"])
    whole = profile.merge_profiles(profile.kept_states(spark, path))
    return whole.select("attribute", "missing_count", "count", *[F.round(c, 3).alias(c) for c in ("mean", "std", "min", "max")])


def rounded(stats: DataFrame, *columns: str) -> DataFrame:
    return stats.withColumns({c: F.round(c, 4) for c in columns})


def numeric_stats(spark, folder):
    stats = profile.numeric_stats(nulls_in_frame(raw_a(spark, folder)), PROFILED_NUMERIC)
    return rounded(stats, "mean", "std", "min", "max")


def describe_numeric(spark, folder):
    stats = quantiles.describe_numeric(
        spread(table(spark, folder, "lineitem"), "l_orderkey"))
    return rounded(stats, "mean", "std", "min", "max", "q25", "q50", "q75")


def describe_nan(spark, folder):
    price = F.when(F.col("o_orderkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    stats = quantiles.describe_numeric(table(spark, folder, "orders").select(price.cast("double").alias("price")))
    return rounded(stats, "mean", "std", "min", "max", "q25", "q50", "q75")


def table_shape(spark, folder):
    return profile.table_shape(raw_b(spark, folder))


def attribute_roles(spark, folder):
    b = mediated(spark, folder)[1].drop("pos")
    return profile.attribute_roles(profile.profile_summary(b), b.agg(F.count("*")).scalar())


def constant_columns(spark, folder):
    a = mediated(spark, folder)[0]
    return profile.constant_columns(a, MEDIATED.names)


# Splits and samples -----------------------------------------------------------------------------

# Columns of pairs that splits, and the linker and the classifier, go by: no others are written for them.
IDS = ("id_A", "id_B", "label")
LINKED = (*IDS, *[f"{c}_{s}" for c in candidates.COMPARED for s in ("A", "B")])


def split_of(spark, folder, strategy=B1, columns=("*",)):
    staged = stage(gt(spark, folder, strategy).select(*columns), f"pairs-{strategy.name}")
    return split.split_stratified(staged).withColumn("strategy", F.lit(strategy.name))


def split_stratified(spark, folder):
    return split_of(spark, folder, columns=IDS).select("id_A", "id_B", "label", "split")


def split_sizes(spark, folder):
    return split.split_sizes(split_of(spark, folder, B1, IDS).unionByName(
        split_of(spark, folder, B2, IDS)))


def prepared_splits(spark, folder):
    a, b = mediated(spark, folder)
    path = labelling.prepare_splits(a, b, new_path(spark, "prepared"), order=ORDER).path
    return spark.read.parquet(path).select("id_A", "id_B", "label", "split", "strategy")


def prepared_counts(spark, folder):
    """What was counted while the splits were written."""
    return labelling.prepare_splits(*mediated(spark, folder), new_path(spark, "prepared"), order=ORDER).counts


def linker_inputs(spark, folder):
    """Linker records and known links behind the training pairs."""
    train = stage(split_of(spark, folder, columns=LINKED).filter(F.col("split") == "train"), "train")
    return pairs.records_for_linker(train.drop("label", "split", "strategy")), pairs.true_links(train)


def sample_extras(spark, folder):
    records, links = linker_inputs(spark, folder)
    ids = records.filter(F.col("source") == "A").select("id")
    return sampling.sample_ids(ids, links.select(F.col("id_A").alias("id")))


def sampled_sides(records, links):
    return [sampling.sample_ids(records.filter(F.col("source") == s).select("id"),
                                links.select(F.col(f"id_{s}").alias("id"))) for s in ("A", "B")]


def sample_negatives(spark, folder):
    records, links = linker_inputs(spark, folder)
    records, links = stage(records, "records"), stage(links, "links")
    return sampling.sample_negatives(*sampled_sides(records, links), links)


def training_pairs(spark, folder):
    records, links = linker_inputs(spark, folder)
    records, links = stage(records, "records"), stage(links, "links")
    return compare.join_records(sampling.training_pairs(records, links), records, "model", "make",
                                "price")


# Comparison and models --------------------------------------------------------------------------

def jw_threshold(spark, folder):
    g = gt(spark, folder)
    model_a, model_b = norm_compare(F.col("model_A")), norm_compare(F.col("description_B"))
    return g.select("id_A", "id_B", jaro_winkler_at_least(
        norm_compare(F.col("model_A")), norm_compare(F.col("model_B")),
        MODEL_SIMILARITY_THRESHOLD).alias("model"),
        jaro_winkler_at_least(model_a, model_b, 0.7).alias("described"))


def sim_linear_year(spark, folder):
    return gt(spark, folder).select("id_A", "id_B", F.round(
        linear(F.col("year_A"), F.col("year_B"), 5), 6).alias("year"))


def sim_linear_bin(spark, folder):
    return gt(spark, folder).select(
        "id_A", "id_B",
        F.round(linear(mileage_bin(F.col("mileage_A")), mileage_bin(F.col("mileage_B")), 2), 6
                ).alias("mileage"),
        F.round(linear(F.col("price_A"), F.col("price_B"), 3, offset=1.5), 6).alias("price"))


def sim_exact(spark, folder):
    return gt(spark, folder).select(
        "id_A", "id_B", exact(F.col("state_A"), F.col("state_B")).alias("state"),
        exact(norm_compare(F.col("make_A")), norm_compare(F.col("make_B"))).alias("make"),
        exact(F.col("body_type_A"), F.col("body_type_B")).alias("body_type"))


def pair_features(spark, folder):
    features = compare.pair_features(gt(spark, folder), "label")
    return rounded(features, "year", "mileage")


def lr_fit_predict(spark, folder):
    splits = stage(split_of(spark, folder, columns=LINKED), "splits")
    result = classification.classify(splits.filter(F.col("split") == "train"),
                                     splits.filter(F.col("split") == "test"))
    return result.predictions.select("id_A", "id_B", "label", "prediction",
                                     F.round("score", 3).alias("score"))


def lr_score_fixed(spark, folder):
    return fixed_scores(spark, folder).select("id_A", "id_B", "label", "prediction",
                                              F.round("score", 6).alias("score"))


def confusion(spark, folder):
    return metrics.confusion(fixed_scores(spark, folder))


def metrics_pairs(spark, folder):
    return rounded(metrics.pair_metrics(fixed_scores(spark, folder)), "precision", "recall", "f1")


def predicted_links(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction") == 1).select("id_A", "id_B")


def metrics_links(spark, folder):
    scored = staged_scores(spark, folder)
    return rounded(metrics.link_metrics(pairs.true_links(scored), predicted_links(scored)),
                   "precision", "recall", "f1")


def links_intersect(spark, folder):
    scored = staged_scores(spark, folder)
    return pairs.true_links(scored).intersect(predicted_links(scored))


def links_except(spark, folder):
    # Both differences in one pass: a link's label and prediction side by side.
    links = fixed_scores(spark, folder).groupBy("id_A", "id_B").agg(
        F.max("label").alias("label"), F.max("prediction").alias("prediction"))
    kind = F.when(F.col("prediction") == 1, "false_positive").otherwise("false_negative")
    return links.filter(F.col("label") != F.col("prediction")).select("id_A", "id_B", kind.alias("kind"))


def links_distinct(spark, folder):
    return dedup.links(gt(spark, folder).unionByName(gt(spark, folder, B2), allowMissingColumns=True))


def linker_features(spark, folder):
    g = mediate.drop_leakage(gt(spark, folder))
    texts = [f"{c}_{s}" for c in ("model", "make", "year", "state") for s in ("A", "B")]
    normal = g.withColumns({c: norm_linker(F.col(c).cast("string")) for c in texts})
    return rounded(compare.linker_features(normal, "id_A", "id_B", "label").select(
        "id_A", "id_B", "label", "price", "mileage", "year_missing", "price_missing",
        "mileage_missing", "state_missing"), "price", "mileage")


def linker_distances(spark, folder):
    g = mediate.drop_leakage(gt(spark, folder))
    texts = [f"{c}_{s}" for c in ("model", "make", "year", "state") for s in ("A", "B")]
    normal = g.withColumns({c: norm_linker(F.col(c).cast("string")) for c in texts})
    return compare.linker_features(normal, "id_A", "id_B").select(
        "id_A", "id_B", "model", "make", "year", "state")


def block_learn(spark, folder):
    records, links = linker_inputs(spark, folder)
    records, links = stage(records, "records"), stage(links, "links")
    return candidates.learn_blocking(records, links).as_table(spark)


# Two rules for the candidate query: equal model and price step, equal year and mileage.
FIXED_RULES = (candidates.Rule(("model_whole", "price_log", "mileage_log")),
               candidates.Rule(("model_first3", "year_whole", "mileage_whole")))


def all_profiles(spark, folder):
    records = stage(pairs.records_for_linker(gt(spark, folder).select(*LINKED).drop("label")), "records")
    return stage(candidates.profiles(candidates.with_profile(records)), "profiles")


def candidate_pairs(spark, folder):
    met = candidates.candidate_pairs(all_profiles(spark, folder), FIXED_RULES, *candidates.COMPARED)
    return met.select(*[F.col(f"{c}_{s}") for c in candidates.COMPARED for s in ("A", "B")])


def block_costs(spark, folder):
    costs = candidates.rule_costs(all_profiles(spark, folder), FIXED_RULES)
    return costs.select("rule", *[F.col(c).cast("bigint").alias(c) for c in ("pairs", "largest")])


def profile_copies(spark, folder):
    return all_profiles(spark, folder).select("source", "copies", *candidates.COMPARED)


def linker_fit(spark, folder):
    records, links = linker_inputs(spark, folder)
    records, links = stage(records, "records"), stage(links, "links")
    examples = write_json(linkage.labelled_examples(records, links), new_path(spark, "examples"))
    fitted = models.load_or_fit(spark, new_path(spark, "model"),
                                lambda: linkage.fit_linker(examples))
    features = compare.linker_features(examples, "id_A", "id_B", "label")
    return models.predict(features, *models.weights(fitted)).select(
        "id_A", "id_B", "label", "prediction", F.round("score", 2).alias("score"))


def one_to_one(spark, folder):
    # Scores are rounded before they are compared, see below.
    scored = staged_scores(spark, folder).filter(F.col("prediction") == 1)
    return assign.one_to_one(scored.select("id_A", "id_B", F.round("score", 6).alias("score")), 0.0)


def one_to_one_round1(spark, folder):
    scored = staged_scores(spark, folder).filter(F.col("prediction") == 1)
    # Scores are rounded before they are compared, so that the last digit of
    # an exponential cannot order two equal feature vectors.
    pairs_ = scored.select("id_A", "id_B", F.round("score", 6).alias("score"))
    return assign.mutual_best(assign.with_tie(pairs_)).select("id_A", "id_B", "score")


def link_join(spark, folder):
    splits = stage(split_of(spark, folder, columns=LINKED), "splits")
    result = linkage.train_and_link(splits.filter(F.col("split") == "train"),
                                    splits.filter(F.col("split") == "test"))
    return result.links.select("id_A", "id_B", F.round("score", 2).alias("score"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_text_na": scan_text_na,
    "scan_quoted": scan_quoted,
    "scan_typed": scan_typed_orders,
    "scan_inferred": scan_inferred,
    "sink_roundtrip": sink_roundtrip,
    "sink_partitioned": sink_partitioned,
    "mediate_a": mediate_a,
    "mediate_b": mediate_b,
    "mediate_absent": mediate_absent,
    "drop_leakage": drop_leakage,
    "preview": preview,
    "to_numeric": to_number_query,
    "norm_block": on_documents(norm_block),
    "norm_compare": on_documents(norm_compare),
    "norm_linker": on_documents(norm_linker),
    "norm_block_pages": on_pages(norm_block),
    "norm_compare_pages": on_pages(norm_compare),
    "norm_linker_pages": on_pages(norm_linker),
    "clean_key17": clean_key17,
    "mileage_bin": mileage_bin_query,
    "block_key_b1": block_key(B1),
    "block_key_b2": block_key(B2),
    "block_text_drop": block_text_drop,
    "gt_b1": gt_b1,
    "gt_b2": gt_b2,
    "gt_capped": gt_capped,
    "gt_positives": gt_positives,
    "gt_negatives": gt_negatives,
    "gt_drop_missing": gt_drop_missing,
    "topk_block": topk_block,
    "dedup_vin_first": dedup_vin("first", 0),
    "dedup_vin_last": dedup_vin("last", 1),
    "upsert_chunks": upsert_chunks,
    "records_from_pairs": records_from_pairs,
    "records_for_linker": records_for_linker,
    "label_sample": label_sample,
    "semi_ids": semi_ids,
    "anti_pairs": anti_pairs,
    "profile_missing": profile_missing,
    "profile_distinct": profile_distinct,
    "profile_summary": profile_summary,
    "profile_top": profile_top,
    "profile_approx": profile_approx,
    "profile_merge": profile_merge,
    "profile_states": profile_states,
    "numeric_stats": numeric_stats,
    "describe_numeric": describe_numeric,
    "describe_nan": describe_nan,
    "table_shape": table_shape,
    "attribute_roles": attribute_roles,
    "constant_columns": constant_columns,
    "split_stratified": split_stratified,
    "split_sizes": split_sizes,
    "prepared_splits": prepared_splits,
    "prepared_counts": prepared_counts,
    "sample_extras": sample_extras,
    "sample_negatives": sample_negatives,
    "training_pairs": training_pairs,
    "jw_threshold": jw_threshold,
    "sim_linear_year": sim_linear_year,
    "sim_linear_bin": sim_linear_bin,
    "sim_exact": sim_exact,
    "pair_features": pair_features,
    "lr_fit_predict": lr_fit_predict,
    "lr_score_fixed": lr_score_fixed,
    "confusion": confusion,
    "metrics_pairs": metrics_pairs,
    "metrics_links": metrics_links,
    "links_intersect": links_intersect,
    "links_except": links_except,
    "links_distinct": links_distinct,
    "linker_features": linker_features,
    "linker_distances": linker_distances,
    "block_learn": block_learn,
    "block_costs": block_costs,
    "profile_copies": profile_copies,
    "candidates": candidate_pairs,
    "linker_fit": linker_fit,
    "one_to_one_round1": one_to_one_round1,
    "one_to_one": one_to_one,
    "link_join": link_join,
}
