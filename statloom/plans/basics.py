"""Scans, projections, filters, set operations, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from statloom.functions import scalars
from statloom.operators import align, numbering
from statloom.plans import standins
from statloom.plans.catalog import Tables, query


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_table(spark, d):
    return Tables(spark, d).customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("SELECT DISTINCT o_custkey AS iid FROM orders")
def scan_id_list(spark, d):
    return Tables(spark, d).orders.select(F.col("o_custkey").alias("iid")).distinct()


@query("SELECT allele FROM (SELECT p_brand AS allele FROM part UNION SELECT p_type FROM part)")
def scan_allele_dictionary(spark, d):
    p = Tables(spark, d).part
    return p.select(F.col("p_brand").alias("allele")).union(p.select("p_type")).distinct()


@query("SELECT p_partkey, p_name FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS n FROM part) WHERE n BETWEEN 11 AND 60")
def scan_row_range(spark, d):
    p = numbering.numbered(Tables(spark, d).part.select("p_partkey", "p_name"), "p_partkey")
    return p.where("n between 11 and 60").select("p_partkey", "p_name")


#: Codes of the second load follow those of the first; both in the values' own order.
@query("""WITH a AS (SELECT p_brand AS allele, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part WHERE p_brand IS NOT NULL GROUP BY 1),
    b AS (SELECT p_type AS allele, dense_rank() OVER (ORDER BY p_type) + (SELECT max(code) FROM a) AS code FROM part WHERE p_type IS NOT NULL AND p_type NOT IN (SELECT allele FROM a) GROUP BY 1)
    SELECT allele, CAST(code AS BIGINT) AS code FROM a UNION ALL SELECT allele, CAST(code AS BIGINT) FROM b""")
def allele_codes(spark, d):
    """A dictionary of two loads, the second appended without renumbering."""
    p = Tables(spark, d).part
    first = numbering.codes(p.select(F.col("p_brand").alias("allele")), "allele")
    return numbering.codes(p.select(F.col("p_type").alias("allele")), "allele", first)


@query(f"SELECT iid, feat, round(x, 6) AS x FROM {standins.LONG_SQL}")
def scan_matrix_long(spark, d):
    return standins.long(Tables(spark, d)).select("iid", "feat", F.round("x", 6).alias("x"))


@query("SELECT feat, round(sum(x), 5) AS total, count(*) AS n FROM " + standins.LONG_SQL + " GROUP BY feat")
def scan_matrix_wide_unpivot(spark, d):
    from statloom.operators.matrix import wide_to_long

    e = Tables(spark, d).embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(str(i)) for i in range(64)])
    return wide_to_long(e, "vec_id", "feat").groupBy(F.col("feat").cast("int").alias("feat")).agg(F.round(F.sum("x"), 5).alias("total"), F.count("*").alias("n"))


@query("SELECT event_id, event_type AS chr, CAST(floor(epoch(ts)) AS BIGINT) AS pos FROM events")
def scan_positions(spark, d):
    return Tables(spark, d).events.select("event_id", F.col("event_type").alias("chr"), F.unix_timestamp("ts").alias("pos"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def proj_columns(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def proj_drop_column(spark, d):
    return Tables(spark, d).customer.drop("c_name")


@query("SELECT c_mktsegment AS seg_factor, c_acctbal AS acct_numeric, c_custkey AS IID FROM customer")
def proj_rename_reorder(spark, d):
    return Tables(spark, d).customer.withColumnsRenamed({"c_mktsegment": "seg_factor", "c_acctbal": "acct_numeric", "c_custkey": "IID"}).select("seg_factor", "acct_numeric", "IID")


@query("SELECT c_custkey AS IID, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS b, CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS f, CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS h, CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS m, c_acctbal AS acctbal_numeric FROM customer")
def proj_suffix_typed_one_hot(spark, d):
    from statloom.sources.schema import typed_columns

    c = Tables(spark, d).customer.select(F.col("c_custkey").alias("IID"), F.col("c_mktsegment").alias("mktsegment_factor"), F.col("c_acctbal").alias("acctbal_numeric"))
    factors, numbers = typed_columns(c.columns)
    levels = {"b": "BUILDING", "f": "FURNITURE", "h": "HOUSEHOLD", "m": "MACHINERY"}  # the first level, AUTOMOBILE, is the reference
    return c.select("IID", *[(F.col(factors[0]) == v).cast("int").alias(k) for k, v in levels.items()], *numbers)


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) || ':' || CAST(p_partkey AS VARCHAR) || '_' || least(p_brand, p_type) || '_' || greatest(p_brand, p_type) AS id FROM part")
def proj_variant_id(spark, d):
    return Tables(spark, d).part.select("p_partkey", scalars.variant_id("p_size", "p_partkey", "p_brand", "p_type").alias("id"))


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^Brand#[0-9]+$') AND NOT regexp_matches(p_type, '[^A-Z ]')")
def filter_regex(spark, d):
    return Tables(spark, d).part.where(F.col("p_brand").rlike("^Brand#[0-9]+$") & ~F.col("p_type").rlike("[^A-Z ]")).select("p_partkey", "p_brand")


_VARIANT_QC = f"""(SELECT feat AS variant, avg(g) / 2 AS af, avg(CAST(m AS INTEGER)) AS missing FROM
    (SELECT feat, CASE WHEN (iid * 7 + feat) % 23 <> 0 THEN g END AS g, (iid * 7 + feat) % 23 = 0 AS m FROM {standins.DOSE_SQL}) GROUP BY feat)"""


def _with_missing(t: Tables):
    return standins.dosages(t).withColumn("g", F.when((F.col("iid") * 7 + F.col("feat")) % 23 != 0, F.col("g")))


@query(f"SELECT variant, round(af, 6) AS af, round(missing, 6) AS missing FROM {_VARIANT_QC} WHERE least(af, 1 - af) >= 0.01 AND missing <= 0.05")
def filter_variant_qc(spark, d):
    from statloom.operators import quality

    return quality.variant_summary(_with_missing(Tables(spark, d)), "feat").where("least(af, 1 - af) >= 0.01 and missing <= 0.05").select(F.col("feat").alias("variant"), F.round("af", 6).alias("af"), F.round("missing", 6).alias("missing"))


@query(f"SELECT iid, count(*) AS n FROM {standins.DOSE_SQL} WHERE iid NOT IN (SELECT iid FROM {standins.DOSE_SQL} GROUP BY iid HAVING avg(CAST((iid * 7 + feat) % 23 = 0 AS INTEGER)) > 0.05) GROUP BY iid")
def filter_sample_qc(spark, d):
    dose = _with_missing(Tables(spark, d))
    bad = dose.groupBy("iid").agg(F.avg(F.isnull("g").cast("int")).alias("m")).where("m > 0.05")
    return dose.join(bad, "iid", "left_anti").groupBy("iid").agg(F.count("*").alias("n"))


@query("SELECT p_partkey FROM part WHERE p_size BETWEEN 1 AND 23")
def filter_chromosomes(spark, d):
    return Tables(spark, d).part.where("p_size between 1 and 23").select("p_partkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount < 0.08 AND l_quantity >= 30")
def filter_quality_scores(spark, d):
    return Tables(spark, d).lineitem.where("l_discount < 0.08 and l_quantity >= 30").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def filter_keep_list(spark, d):
    t = Tables(spark, d)
    return t.customer.join(t.orders.where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def filter_remove_list(spark, d):
    t = Tables(spark, d)
    return t.customer.join(t.orders.where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


_ALLELES_SQL = "(SELECT p_partkey AS id, substr('ACGTRID-', CAST(1 + p_partkey % 8 AS INTEGER), 1) AS a1, substr('ACGTRIDAN', CAST(1 + (p_partkey // 3) % 9 AS INTEGER), 1) AS a2 FROM part)"


def _alleles(t: Tables):
    return t.part.selectExpr("p_partkey as id", "substr('ACGTRID-', cast(1 + p_partkey % 8 as int), 1) as a1", "substr('ACGTRIDAN', cast(1 + (p_partkey div 3) % 9 as int), 1) as a2")


@query(f"SELECT DISTINCT id FROM {_ALLELES_SQL} WHERE a1 NOT IN ('A','C','G','T') OR a2 NOT IN ('A','C','G','T') OR a1 = a2")
def filter_harmonisation_rejects(spark, d):
    from statloom.operators import quality

    return _alleles(Tables(spark, d)).withColumn("why", quality.allele_reject("a1", "a2")).where("why is not null").select("id").distinct()


@query("SELECT k, min(v) AS v FROM (SELECT o_custkey AS k, o_orderstatus AS v FROM orders) GROUP BY k HAVING count(DISTINCT v) = 1")
def filter_duplicate_ids(spark, d):
    return align.exclude_mismatch(Tables(spark, d).orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v")), "k", "v")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type, date_trunc('hour', ts) HAVING count(*) = 1")
def filter_duplicate_positions(spark, d):
    e = Tables(spark, d).events.withColumn("n", F.count("*").over(Window.partitionBy("user_id", "event_type", F.date_trunc("hour", "ts"))))
    return e.where("n = 1").select("user_id", "event_type", "event_id")


@query(f"SELECT feat FROM (SELECT feat, avg(g) / 2 AS af FROM {standins.DOSE_SQL} GROUP BY feat) WHERE af > 0.3 AND af < 0.7 AND af <> 0.5")
def filter_maf_strict(spark, d):
    from statloom.operators.assoc import maf_filter

    return standins.dosages(Tables(spark, d)).groupBy("feat").agg((F.avg("g") / 2).alias("af")).where(maf_filter(F.col("af"), 0.3)).select("feat")


@query(f"SELECT label, feat, CASE WHEN af >= 0.4 AND af <= 0.6 AND af <> 0.5 THEN feat ELSE -1 END AS idx FROM (SELECT label, feat, avg(g) / 2 AS af FROM {standins.DOSE_SQL} GROUP BY label, feat)")
def filter_maf_by_cohort(spark, d):
    from statloom.operators.assoc import maf_filter

    af = standins.dosages(Tables(spark, d)).groupBy("label", "feat").agg((F.avg("g") / 2).alias("af"))
    return af.select("label", "feat", F.when(maf_filter(F.col("af"), 0.4, True), F.col("feat")).otherwise(-1).alias("idx"))


@query("SELECT p_partkey FROM part WHERE p_partkey IN (1, 5, 9, 30) OR (p_size, p_brand) IN (SELECT p_size, p_brand FROM part WHERE p_partkey % 50 = 0)")
def filter_include_by_id_or_position(spark, d):
    p = Tables(spark, d).part
    near = p.where("p_partkey % 50 = 0").select("p_size", "p_brand").distinct()
    return p.where(F.col("p_partkey").isin(1, 5, 9, 30)).select("p_partkey").union(p.join(near, ["p_size", "p_brand"], "left_semi").select("p_partkey")).distinct()


@query("SELECT feat FROM (SELECT feat, CASE WHEN feat % 9 = 0 THEN 1e0 WHEN feat % 11 = 0 THEN NULL ELSE x END AS v FROM " + standins.LONG_SQL + ") GROUP BY feat HAVING count(DISTINCT v) > 1")
def filter_constant_features(spark, d):
    x = standins.long(Tables(spark, d)).withColumn("v", F.when(F.col("feat") % 9 == 0, 1.0).when(F.col("feat") % 11 != 0, F.col("x")))
    return x.groupBy("feat").agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a < b").select("feat")


@query("SELECT label FROM embeddings GROUP BY label HAVING var_samp(vec_id) > 0")
def filter_zero_variance(spark, d):
    return Tables(spark, d).embeddings.groupBy("label").agg(F.var_samp("vec_id").alias("v")).where("v > 0").select("label")


@query("SELECT doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def filter_complete_rows(spark, d):
    t = Tables(spark, d)
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").dropna().select("doc_id")


@query("SELECT source FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source HAVING count(quality) > 0.3 * count(*)")
def filter_detection_share(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id", "left").groupBy("source").agg(F.count("quality").alias("q"), F.count("*").alias("n")).where("q > 0.3 * n").select("source")


@query("SELECT event_id, CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'X in F' WHEN event_type = 'click' THEN 'X in M' WHEN event_type = 'view' AND user_id % 2 = 1 THEN 'Y in M' ELSE 'autosome' END AS stratum FROM events WHERE NOT (event_type = 'view' AND user_id % 2 = 0)")
def filter_strata(spark, d):
    e = Tables(spark, d).events
    odd = F.col("user_id") % 2 == 1
    s = F.when((F.col("event_type") == "click") & ~odd, "X in F").when(F.col("event_type") == "click", "X in M").when((F.col("event_type") == "view") & odd, "Y in M").when(F.col("event_type") != "view", "autosome")
    return e.select("event_id", s.alias("stratum")).where("stratum is not null")


@query("SELECT p_partkey, CAST(ceil(n / ceil(t / 10.0)) AS BIGINT) AS chunk FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS n, count(*) OVER () AS t FROM part)")
def filter_feature_chunks(spark, d):
    p = Tables(spark, d).part
    t = p.count()
    return numbering.numbered(p.select("p_partkey"), "p_partkey").select("p_partkey", F.ceil(F.col("n") / F.ceil(F.lit(t / 10.0))).cast("long").alias("chunk"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 7")
def filter_point_lookup(spark, d):
    return Tables(spark, d).orders.where("o_orderkey = 7").select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey FROM part WHERE NOT (p_size = 6 AND p_partkey BETWEEN 25 AND 1500)")
def filter_region_exclusion(spark, d):
    return Tables(spark, d).part.where("not (p_size = 6 and p_partkey between 25 and 1500)").select("p_partkey")


@query("SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 5000")
def filter_half_open_range(spark, d):
    return Tables(spark, d).customer.where("c_acctbal >= 0 and c_acctbal < 5000").select("c_custkey")


@query("SELECT p_partkey, CASE WHEN p_size < 25 THEN 'young' ELSE 'old' END AS age FROM part WHERE p_size <> 25")
def filter_age_split(spark, d):
    return Tables(spark, d).part.where("p_size != 25").select("p_partkey", F.when(F.col("p_size") < 25, "young").otherwise("old").alias("age"))


@query("SELECT l_orderkey, l_linenumber, round(-log10(l_discount + 0.0001), 6) AS score FROM lineitem WHERE -log10(l_discount + 0.0001) > 2")
def filter_log_threshold(spark, d):
    s = -F.log10(F.col("l_discount") + 0.0001)
    return Tables(spark, d).lineitem.where(s > 2).select("l_orderkey", "l_linenumber", F.round(s, 6).alias("score"))


@query("SELECT p_partkey, CASE WHEN p_partkey BETWEEN 60 AND 270 OR p_partkey > 1540 THEN 25 ELSE 23 END AS chr FROM part WHERE p_size = 23")
def filter_pseudo_autosomal(spark, d):
    return Tables(spark, d).part.where("p_size = 23").select("p_partkey", F.when(F.expr("p_partkey between 60 and 270 or p_partkey > 1540"), 25).otherwise(23).alias("chr"))


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region")
def set_union_distinct(spark, d):
    t = Tables(spark, d)
    return t.nation.select(F.col("n_name").alias("name")).union(t.region.select("r_name")).distinct()


@query("SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def set_union_all(spark, d):
    t = Tables(spark, d)
    return t.customer.select(F.col("c_nationkey").alias("nationkey")).unionByName(t.supplier.select(F.col("s_nationkey").alias("nationkey")))


@query("SELECT n_name AS name, n_regionkey AS regionkey, NULL::DOUBLE AS acctbal FROM nation UNION ALL SELECT s_name, NULL, CAST(s_nationkey AS DOUBLE) FROM supplier")
def set_union_missing_columns(spark, d):
    t = Tables(spark, d)
    return t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("regionkey")).unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("double").alias("acctbal")), allowMissingColumns=True)


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, d):
    t = Tables(spark, d)
    return t.customer.select(F.col("c_nationkey").alias("k")).intersect(t.supplier.select("s_nationkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 490000")
def set_except(spark, d):
    t = Tables(spark, d)
    return t.customer.select(F.col("c_custkey").alias("k")).subtract(t.orders.where("o_totalprice > 490000").select("o_custkey"))


@query("SELECT r_regionkey, p_size, count(n) AS n FROM region CROSS JOIN (SELECT DISTINCT p_size FROM part WHERE p_size <= 5) LEFT JOIN (SELECT n_regionkey, n_nationkey AS n FROM nation) ON n_regionkey = r_regionkey AND n % 5 + 1 = p_size GROUP BY ALL")
def set_densify_grid(spark, d):
    t = Tables(spark, d)
    grid = t.region.select("r_regionkey").crossJoin(F.broadcast(t.part.where("p_size <= 5").select("p_size").distinct()))
    n = t.nation.select(F.col("n_regionkey").alias("r_regionkey"), (F.col("n_nationkey") % 5 + 1).cast("int").alias("p_size"), F.col("n_nationkey").alias("n"))
    return grid.join(n, ["r_regionkey", "p_size"], "left").groupBy("r_regionkey", "p_size").agg(F.count("n").alias("n"))


@query("SELECT r_regionkey, count(*) FILTER (n % 3 = 0) AS g0, count(*) FILTER (n % 3 = 1) AS g1, count(*) FILTER (n % 3 = 2) AS g2 FROM (SELECT n_regionkey AS r_regionkey, n_nationkey AS n FROM nation) GROUP BY ALL")
def set_transpose(spark, d):
    n = Tables(spark, d).nation.select(F.col("n_regionkey").alias("r_regionkey"), F.concat(F.lit("g"), (F.col("n_nationkey") % 3).cast("string")).alias("g"))
    return n.groupBy("r_regionkey").pivot("g", ["g0", "g1", "g2"]).count().na.fill(0)


@query("SELECT row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) AS n, c_custkey FROM customer")
def sort_multi_key(spark, d):
    c = Tables(spark, d).customer.select("c_mktsegment", "c_acctbal", "c_custkey")
    return numbering.numbered(c, "c_mktsegment", F.desc("c_acctbal"), "c_custkey").select("n", "c_custkey")


@query(f"SELECT feat, round(var_samp(x), 8) AS v FROM {standins.LONG_SQL} GROUP BY feat ORDER BY var_samp(x) DESC, feat LIMIT 20")
def sort_top_by_variance(spark, d):
    return standins.long(Tables(spark, d)).groupBy("feat").agg(F.var_samp("x").alias("v")).orderBy(F.desc("v"), "feat").limit(20).select("feat", F.round("v", 8).alias("v"))


@query("SELECT min(c_custkey) AS first_custkey FROM customer WHERE c_acctbal > 9000")
def sort_first_match(spark, d):
    return Tables(spark, d).customer.agg(F.min(F.when(F.col("c_acctbal") > 9000, F.col("c_custkey"))).alias("first_custkey"))


@query("SELECT o_custkey, min_by(o_orderkey, o_orderkey) AS head, max_by(o_totalprice, o_orderkey) AS tail FROM orders GROUP BY o_custkey")
def sort_head_tail(spark, d):
    return Tables(spark, d).orders.groupBy("o_custkey").agg(F.min_by("o_orderkey", "o_orderkey").alias("head"), F.max_by("o_totalprice", "o_orderkey").alias("tail"))


@query("SELECT p_partkey, chr, bp, a1, a2 FROM (SELECT p_partkey, split_part(id, ':', 1) AS chr, CAST(split_part(split_part(id, ':', 2), '_', 1) AS BIGINT) AS bp, split_part(split_part(id, ':', 2), '_', 2) AS a1, split_part(split_part(id, ':', 2), '_', 3) AS a2 FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) || ':' || CAST(p_partkey AS VARCHAR) || '_A_G' AS id FROM part))")
def fn_split_id(spark, d):
    p = Tables(spark, d).part.withColumn("id", F.concat(F.col("p_size").cast("string"), F.lit(":"), F.col("p_partkey").cast("string"), F.lit("_A_G")))
    return p.select("p_partkey", *scalars.split_variant_id("id")).withColumnRenamed("pos", "bp")


@query("SELECT page_id, length(url) AS n, lower(regexp_extract(url, '^[a-z]+://([^/]+)', 1)) AS host, substr(url, 1, 8) AS head FROM pages")
def fn_strings(spark, d):
    return Tables(spark, d).pages.select("page_id", F.length("url").cast("long").alias("n"), F.lower(F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)).alias("host"), F.substring("url", 1, 8).alias("head"))


@query("SELECT id, least(least(a1, a2) || '/' || greatest(a1, a2), least(c1, c2) || '/' || greatest(c1, c2)) AS pair FROM (SELECT id, a1, a2, translate(a1, 'ACGT', 'TGCA') AS c1, translate(a2, 'ACGT', 'TGCA') AS c2 FROM " + _ALLELES_SQL + ")")
def fn_unordered_alleles(spark, d):
    return _alleles(Tables(spark, d)).select("id", scalars.alleles_unordered("a1", "a2").alias("pair"))


@query("SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events")
def fn_safe_cast(spark, d):
    return Tables(spark, d).events.select("event_id", F.regexp_extract("props", "[0-9]+", 0).try_cast("int").alias("k"))


@query("SELECT p_partkey, CASE WHEN p_size = 50 THEN 23 WHEN p_size = 49 THEN 24 WHEN p_size = 48 THEN 25 WHEN p_size <= 22 THEN p_size END AS chr FROM part")
def fn_chromosome_code(spark, d):
    text = F.when(F.col("p_size") == 50, "chrX").when(F.col("p_size") == 49, "y").when(F.col("p_size") == 48, "MT").otherwise(F.col("p_size").cast("string"))
    return Tables(spark, d).part.select("p_partkey", scalars.chromosome_code(text).alias("chr"))


@query("SELECT iid, feat, round(CASE WHEN x < 0 THEN 21 * exp(x) - 1 ELSE 21 * x + 20 END, 6) AS age FROM " + standins.LONG_SQL + "")
def fn_age_transform(spark, d):
    return standins.long(Tables(spark, d)).select("iid", "feat", F.round(scalars.age_from_clock(F.col("x")), 6).alias("age"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 2.2250738585072014e-308 ELSE l_discount END AS p FROM lineitem")
def fn_positive_p(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", scalars.positive_p(F.col("l_discount").cast("double")).alias("p"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < 0.02 THEN 1 WHEN l_discount < 0.04 THEN 2 WHEN l_discount < 0.07 THEN 3 ELSE 4 END AS band FROM lineitem")
def fn_banding(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", scalars.banded(F.col("l_discount"), [0.02, 0.04, 0.07]).alias("band"))


@query("SELECT vec_id, CASE label % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'Klinefelter' ELSE 'Turner' END AS sex FROM embeddings")
def fn_sex_composition(spark, d):
    k = F.col("label") % 4
    return Tables(spark, d).embeddings.select("vec_id", scalars.sex_from_chromosomes(F.when(k.isin(0, 2), "XX").otherwise("X"), k.isin(1, 2)).alias("sex"))


@query("SELECT doc_id, coalesce(quality, -1) AS quality, CASE WHEN toxic = 1 THEN 2 WHEN toxic = 0 THEN 1 END AS code FROM documents LEFT JOIN labels USING (doc_id)")
def fn_coalesce_recode(spark, d):
    t = Tables(spark, d)
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.when(F.col("toxic") == 1, 2).when(F.col("toxic") == 0, 1).alias("code"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) >= DATE '1996-06-01' AS recent FROM orders")
def fn_date_gate(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", (F.col("o_orderdate").cast("date") >= F.to_date(F.lit("1996-06-01"))).alias("recent"))


@query("SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS level FROM part")
def fn_factor_codes(spark, d):
    return numbering.factor_levels(Tables(spark, d).part.select("p_partkey", "p_brand"), "p_brand").select("p_partkey", F.col("level").cast("int").alias("level"))


@query("SELECT p_partkey, (p_size * 1000 + p_partkey % 100) >= 10050 AS ok FROM part")
def fn_version_compare(spark, d):
    have = F.concat(F.lit("v"), F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 100).cast("string"))
    return Tables(spark, d).part.select("p_partkey", scalars.version_at_least(have, F.lit("10.50")).alias("ok"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))), 6) AS dot, round(sqrt(abs(CAST(embedding[1] AS DOUBLE))), 6) AS root FROM embeddings")
def fn_array_dot(spark, d):
    e = Tables(spark, d).embeddings.withColumn("v", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", F.round(F.aggregate(F.zip_with("v", "v", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b), 6).alias("dot"), F.round(F.sqrt(F.abs(F.col("v")[0])), 6).alias("root"))
