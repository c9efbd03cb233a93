"""Registered queries for scalar functions, projections, aggregates, joins,
windows, sorts and set operations (F, P, A, J, W, L, U keys)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.catalog import _overview, obs, obs_pipeline, obs_raw, org_raw, org_silver, pat, pat_pipeline, pat_raw, register
from lakestrata.functions import scalars as S
from lakestrata.operators import dedup as W
from lakestrata.operators.joins import skew_join
from lakestrata.operators.quantiles import group_quantiles
from lakestrata.operators import quality as Q
from lakestrata.plans import fixtures as X
from lakestrata.plans import gold as G
from lakestrata.plans import silver as V
from lakestrata.session import AS_OF

# --- F: scalar functions ---------------------------------------------------


@register("fn_parse_date")
def q_f1(spark, d):
    return pat_raw(spark, d).select(
        "Id", "source_file", "BIRTHDATE",
        S.parse_date("BIRTHDATE").alias("birth_date"), S.parse_date("DEATHDATE").alias("death_date"),
    )


@register("fn_to_date")
def q_f2(spark, d):
    return obs_raw(spark, d).select("PATIENT", "CODE", "source_file", "obs_ts", S.to_date("obs_ts").alias("obs_date"))


@register("fn_try_int")
def q_f3(spark, d):
    return pat_raw(spark, d).select(
        "Id", "source_file", S.try_int("ZIP").alias("zip"), S.try_int("FIPS").alias("fips"),
        S.try_int("INCOME").alias("income"),
    )


@register("fn_try_double")
def q_f4(spark, d):
    return pat_raw(spark, d).select(
        "Id", "source_file", S.try_double("LAT").alias("lat"), S.try_double("LON").alias("lon"),
        S.try_double("HEALTHCARE_EXPENSES").alias("expenses"), S.try_double("INCOME").alias("income"),
    )


@register("fn_cast_guarded")
def q_f5(spark, d):
    return obs_raw(spark, d).select(
        "PATIENT", "obs_ts", "CODE", "source_file", "VALUE", "TYPE", S.numeric_if("VALUE", "TYPE").alias("numeric_value")
    )


@register("fn_cast_bigint")
def q_f6(spark, d):
    return pat(spark, d).groupBy("STATE").agg(
        S.trunc_bigint(F.avg("HEALTHCARE_EXPENSES")).alias("avg_expenses_int"),
        S.trunc_bigint(F.avg("INCOME")).alias("avg_income_int"),
    )


@register("fn_age_years")
def q_f7(spark, d):
    return pat(spark, d).select(
        "Id", "BIRTHDATE", "DEATHDATE",
        S.age_years("BIRTHDATE", S.today(AS_OF)).alias("age"),
        S.age_years("BIRTHDATE", "DEATHDATE").alias("age_at_death"),
    )


@register("fn_datediff_days")
def q_f8(spark, d):
    return obs_raw(spark, d).select(
        "PATIENT", "obs_ts", "CODE", "source_file",
        S.days_between("ingestion_timestamp", "obs_ts").alias("days_to_ingest"),
    )


@register("fn_hours_between")
def q_f9(spark, d):
    return obs_raw(spark, d).select(
        "PATIENT", "obs_ts", "CODE", "source_file",
        S.hours_between("ingestion_timestamp", "obs_ts", 2).alias("hours_to_ingest"),
    )


@register("fn_hours_whole")
def q_f10(spark, d):
    return obs_raw(spark, d).select(
        "PATIENT", "obs_ts", "CODE", "source_file",
        S.hours_whole("obs_ts", "ingestion_timestamp").alias("whole_hours"),
    )


@register("fn_year")
def q_f11(spark, d):
    return pat(spark, d).select("Id", "BIRTHDATE", S.year("BIRTHDATE").alias("birth_year"))


@register("fn_now")
def q_f12(spark, d):
    return S.stamps(pat_raw(spark, d).select("Id", "source_file"), AS_OF)


@register("fn_upper_lower")
def q_f13(spark, d):
    return org_raw(spark, d).select("Id", S.upper("STATE").alias("state"), S.lower("NAME").alias("name_lower"))


@register("fn_digits_only")
def q_f14(spark, d):
    return org_raw(spark, d).select("Id", "PHONE", S.digits_only("PHONE").alias("phone_digits"))


@register("fn_concat_ws")
def q_f15(spark, d):
    return pat_raw(spark, d).select(
        "Id", "source_file", S.full_name("PREFIX", "FIRST", "MIDDLE", "LAST").alias("full_name")
    )


@register("fn_contains")
def q_f16(spark, d):
    return obs_raw(spark, d).select(
        "PATIENT", "obs_ts", "CODE", "source_file", "CATEGORY",
        S.contains("CATEGORY", "vital").alias("is_vital"), S.contains("CATEGORY", "lab").alias("is_lab"),
    )


@register("fn_trim_length")
def q_f17(spark, d):
    return org_raw(spark, d).select("Id", "NAME", S.not_blank("NAME").alias("name_present"))


@register("fn_round")
def q_f18(spark, d):
    v = F.col("observation_value")
    return obs(spark, d).select(
        "patient_id", "observation_date", "observation_code",
        S.round_to(v, 1).alias("value_r1"), S.round_to(v / 3, 2).alias("third_r2"),
    )


@register("fn_floor")
def q_f19(spark, d):
    return pat(spark, d).select("Id", S.floor(F.col("LAT") / 7).alias("lat_band"), S.floor("HEALTHCARE_EXPENSES").alias("expenses_floor"))


@register("fn_null_tests")
def q_f20(spark, d):
    return pat(spark, d).select(
        "Id", S.is_null("BIRTHDATE").alias("birthdate_missing"), S.not_null("GENDER").alias("gender_present"),
        S.is_null("INCOME").alias("income_missing"),
    )


@register("fn_boolean_logic")
def q_f21(spark, d):
    v = F.col("observation_value")
    return obs(spark, d).select(
        "patient_id", "observation_date", "observation_code",
        S.any_of([S.all_of([v > 100, F.col("category") == "vital-signs"]), F.col("observation_type") == "text"]).alias("flagged"),
        (~(v < 50)).alias("not_low"),
    )


@register("fn_between_dates")
def q_f22(spark, d):
    return pat(spark, d).select(
        "Id", "BIRTHDATE", S.date_in_range("BIRTHDATE", F.lit("1900-01-01").cast("date"), S.today(AS_OF)).alias("birth_in_range")
    )


@register("fn_flag")
def q_f23(spark, d):
    return org_raw(spark, d).select(
        "Id", "UTILIZATION", S.flag(F.col("UTILIZATION") > 100).alias("high_util_int"),
        S.flag(F.col("UTILIZATION") > 100, as_int=False).alias("high_util_bool"),
    )


# --- P: projections and filters -------------------------------------------


@register("project_rename")
def q_p1(spark, d):
    return org_raw(spark, d).select(
        F.col("Id").alias("organization_id"), F.col("NAME").alias("organization_name"), F.col("CITY").alias("city"),
        F.col("REVENUE").alias("revenue"),
    )


@register("derive_column")
def q_p2(spark, d):
    return obs_raw(spark, d).drop("_rescued_data").withColumn("CATEGORY", S.lower("CATEGORY"))


@register("derive_columns")
def q_p3(spark, d):
    o = obs_raw(spark, d)
    return o.select("PATIENT", "obs_ts", "CODE", "source_file", "VALUE").withColumns({
        "missing_patient": S.flag(F.col("PATIENT").isNull()),
        "missing_value": S.flag(S.try_double("VALUE").isNull()),
        "missing_code": S.flag(F.col("CODE").isNull()),
    })


@register("drop_column")
def q_p4(spark, d):
    return pat_raw(spark, d).drop("_rescued_data", "SUFFIX", "MAIDEN", "DRIVERS", "PASSPORT")


@register("filter_rows")
def q_p5(spark, d):
    return obs(spark, d).filter((F.col("category") == "vital-signs") & F.col("observation_value").isNotNull())


@register("filter_in_set")
def q_p6(spark, d):
    return pat_raw(spark, d).filter(F.col("GENDER").isin("M", "F")).select("Id", "source_file", "GENDER")


@register("filter_threshold")
def q_p7(spark, d):
    return _overview(spark, d).filter(F.col("total_observations") > 20)


@register("case_banding")
def q_p8(spark, d):
    p = pat(spark, d).select("Id", S.age_years("BIRTHDATE", S.today(AS_OF)).alias("age"))
    return p.withColumn("age_group", G.age_band(F.col("age")))


@register("scalar_subquery")
def q_p9(spark, d):
    b = pat_raw(spark, d)
    s = pat_pipeline(spark, d)
    return W.dedup_stats(b, s).select(
        F.col("total_records").alias("bronze_count"), F.col("unique_records").alias("silver_count"),
        F.col("duplicates_removed"),
    )


@register("constant_column")
def q_p10(spark, d):
    return pat(spark, d).select(F.lit("silver").alias("layer"), F.lit("patients").alias("entity"), "Id")


# --- A: aggregations -------------------------------------------------------


def _lineitem(spark, d, cols):
    return X.read(spark, d, "lineitem", cols)


@register("agg_global")
def q_a1(spark, d):
    li = _lineitem(spark, d, ["l_quantity", "l_extendedprice", "l_shipdate"])
    return li.agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_extendedprice").alias("avg_price"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@register("agg_grouped")
def q_a2(spark, d):
    li = _lineitem(spark, d, ["l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    price = F.col("l_extendedprice")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.sum(price).alias("sum_base_price"),
        F.sum(price * (1 - F.col("l_discount"))).alias("sum_disc_price"),
        F.avg("l_quantity").alias("avg_qty"),
        F.avg("l_discount").alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"),
    )


@register("agg_count")
def q_a3(spark, d):
    return obs(spark, d).agg(
        F.count(F.lit(1)).alias("rows"), F.count("observation_value").alias("values_present"),
        F.count("patient_id").alias("patients_present"),
    )


@register("agg_count_distinct")
def q_a4(spark, d):
    return obs(spark, d).groupBy("observation_code").agg(
        F.count_distinct("patient_id").alias("unique_patients"), F.count_distinct("encounter_id").alias("unique_encounters"),
    )


@register("agg_min_max")
def q_a5(spark, d):
    o = X.read(spark, d, "orders", ["o_orderpriority", "o_totalprice", "o_orderdate"])
    return o.groupBy("o_orderpriority").agg(
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"),
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
    )


@register("agg_avg_sum")
def q_a6(spark, d):
    o = X.read(spark, d, "orders", ["o_orderstatus", "o_totalprice"])
    return o.groupBy("o_orderstatus").agg(F.avg("o_totalprice").alias("avg_price"), F.sum("o_totalprice").alias("total_price"))


@register("agg_stddev")
def q_a7(spark, d):
    li = _lineitem(spark, d, ["l_returnflag", "l_quantity", "l_discount"])
    return li.groupBy("l_returnflag").agg(
        F.stddev_samp("l_quantity").alias("stddev_qty"), F.stddev_samp("l_discount").alias("stddev_disc")
    )


@register("agg_conditional_sum")
def q_a8(spark, d):
    return obs(spark, d).groupBy("category").agg(
        F.sum(F.when(F.col("observation_type") == "numeric", 1).otherwise(0)).alias("numeric_rows"),
        F.count_if(F.col("observation_type") == "text").alias("text_rows"),
        F.count_if(F.col("has_quality_issue") == 1).alias("issue_rows"),
    )


@register("agg_percentile")
def q_a9(spark, d):
    li = _lineitem(spark, d, ["l_linestatus", "l_extendedprice"])
    return group_quantiles(li, ["l_linestatus"], "l_extendedprice", {"p25": 0.25, "median": 0.5, "p75": 0.75})


@register("agg_first")
def q_a10(spark, d):
    return obs(spark, d).groupBy("observation_code").agg(F.min("units").alias("units"))


@register("agg_span_days")
def q_a11(spark, d):
    return obs(spark, d).groupBy("patient_id").agg(
        F.datediff(F.max("observation_date"), F.min("observation_date")).alias("span_days")
    )


@register("agg_ratio_post")
def q_a12(spark, d):
    g = pat(spark, d).groupBy("STATE").agg(
        F.avg("HEALTHCARE_EXPENSES").alias("avg_exp"), F.avg("INCOME").alias("avg_inc"),
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("data_quality_flag") == 0).alias("clean"),
    )
    return g.select(
        "STATE", S.ratio("avg_exp", "avg_inc", 4).alias("expense_to_income"),
        S.ratio("clean", "n", 2, 100.0).alias("clean_pct"),
    )


@register("agg_value_counts")
def q_a13(spark, d):
    return Q.value_counts(obs(spark, d), "observation_type")


@register("agg_having")
def q_a14(spark, d):
    return W.duplicate_keys(pat_raw(spark, d), ["Id"])


@register("agg_reaggregate")
def q_a15(spark, d):
    g1 = G.demographics(pat(spark, d))
    return g1.groupBy("GENDER", "STATE").agg(
        F.sum("patient_count").alias("total_patients"), F.avg("avg_income").alias("avg_of_avg_income"),
    )


@register("agg_distinct_rows")
def q_a16(spark, d):
    o = obs_raw(spark, d)
    cats = o.select("CATEGORY").distinct().select(F.count(F.lit(1))).scalar()
    pats = o.select("PATIENT").distinct().select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(cats.alias("distinct_categories"), pats.alias("distinct_patients"))


# --- J: joins --------------------------------------------------------------


@register("join_inner")
def q_j1(spark, d):
    dim = pat(spark, d).select(F.col("Id").alias("patient_id"), "GENDER", "STATE")
    facts = obs(spark, d).select("patient_id", "observation_date", "observation_code", "observation_value")
    return skew_join(facts, dim, "patient_id", "inner")


@register("join_left_agg")
def q_j2(spark, d):
    per = obs(spark, d).groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_obs"))
    dim = pat(spark, d).select(F.col("Id").alias("patient_id"), "GENDER", "STATE")
    return per.join(dim, "patient_id", "left")


@register("join_semi_in")
def q_j3(spark, d):
    raw = pat_raw(spark, d)
    dups = W.duplicate_keys(raw, ["Id"]).select("Id")
    return skew_join(raw.select("Id", "source_file", "MARITAL"), dups, "Id", "left_semi")


# --- W: windows --------------------------------------------------------------


@register("dedup_latest")
def q_w1(spark, d):
    latest = W.dedup_latest(
        pat_raw(spark, d), ["Id"], [F.desc_nulls_last("ingestion_timestamp")], [F.desc_nulls_last("source_file")]
    )
    return latest.select("Id", "source_file", "MARITAL", "ingestion_timestamp")


LINEITEM_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("dedup_composite")
def q_w2(spark, d):
    li = _lineitem(spark, d, ["l_orderkey", "l_linenumber", "l_shipdate", *LINEITEM_TIES])
    return W.dedup_latest(
        li, ["l_orderkey", "l_linenumber"], [F.desc_nulls_last("l_shipdate")], [F.asc_nulls_first(c) for c in LINEITEM_TIES]
    )


@register("duplicate_rank")
def q_w3(spark, d):
    raw = pat_raw(spark, d).select("Id", "FIRST", "LAST", "BIRTHDATE", "source_file", "ingestion_timestamp")
    return W.duplicate_rank(raw, ["Id"], [F.desc_nulls_last("ingestion_timestamp"), F.desc_nulls_last("source_file")])


@register("dedup_stats")
def q_w4(spark, d):
    return W.dedup_stats(pat_raw(spark, d), pat(spark, d))


# --- L: sort and limit -------------------------------------------------------


@register("sort_desc")
def q_l1(spark, d):
    c = obs(spark, d).groupBy("observation_code").agg(F.count(F.lit(1)).alias("n"))
    return Q.sort_desc(c, "n", [F.asc("observation_code")])


@register("top_k")
def q_l2(spark, d):
    return Q.top_k(_overview(spark, d), 10, [F.desc("total_observations")], [F.asc("patient_id")])


@register("limit_sample")
def q_l3(spark, d):
    return Q.preview(pat(spark, d).select("Id", "FIRST", "LAST", "BIRTHDATE", "INCOME"), 5, [F.asc("Id")])


# --- U: set operations -------------------------------------------------------


@register("union_all_metrics")
def q_u1(spark, d):
    p = pat_pipeline(spark, d)
    o = org_silver(spark, d)
    b = obs_pipeline(spark, d)

    def m(df, entity, key):
        return df.agg(
            F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("record_count"),
            F.count_distinct(key).alias("unique_keys"), F.max("silver_timestamp").alias("latest_refresh"),
        )

    return Q.stack_metrics(m(p, "Patients", "patient_id"), m(o, "Organizations", "organization_id"),
                           m(b, "Observations", "patient_id"))


@register("distinct_values")
def q_u2(spark, d):
    return Q.distinct_values(obs_raw(spark, d), "CATEGORY")


@register("schema_diff")
def q_u3(spark, d):
    declared = {"Id": "string", "BIRTHDATE": "date", "LAT": "double", "INCOME": "int", "FAX": "string"}
    return Q.schema_diff(pat_raw(spark, d).select("Id", "BIRTHDATE", "GENDER", "LAT", "INCOME"), declared)
