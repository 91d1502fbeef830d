"""Joins: alignment by id, mapping of variants, positions and intervals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from statloom.operators import align, ranges
from statloom.plans.catalog import Tables, query

_POS = "(SELECT event_id, event_type AS chr, CAST(floor(epoch(ts)) AS BIGINT) AS pos FROM events)"


def _positions(t: Tables):
    return t.events.select("event_id", F.col("event_type").alias("chr"), F.unix_timestamp("ts").alias("pos"))


@query("SELECT DISTINCT c_custkey AS iid FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey IN (SELECT user_id FROM events)")
def align_intersect_ids(spark, d):
    t = Tables(spark, d)
    return align.common_ids([t.customer.select(F.col("c_custkey").alias("iid")), t.orders.select(F.col("o_custkey").alias("iid")), t.events.select(F.col("user_id").alias("iid"))], "iid")


@query("SELECT c_custkey AS iid, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1) ON c_custkey = o_custkey")
def align_match_first(spark, d):
    t = Tables(spark, d)
    return align.first_match(t.customer.select(F.col("c_custkey").alias("iid")), t.orders.select(F.col("o_custkey").alias("iid"), "o_orderkey", "o_totalprice"), "iid", ["o_orderkey"])


@query("""SELECT coalesce(a.iid, b.iid, c.iid) AS iid, bal, orders, events FROM (SELECT c_custkey AS iid, c_acctbal AS bal FROM customer) a
    FULL JOIN (SELECT o_custkey AS iid, count(*) AS orders FROM orders GROUP BY 1) b ON a.iid = b.iid
    FULL JOIN (SELECT user_id AS iid, count(*) AS events FROM events GROUP BY 1) c ON coalesce(a.iid, b.iid) = c.iid""")
def align_full_chain(spark, d):
    t = Tables(spark, d)
    return align.full_chain([t.customer.select(F.col("c_custkey").alias("iid"), F.col("c_acctbal").alias("bal")), t.orders.groupBy(F.col("o_custkey").alias("iid")).agg(F.count("*").alias("orders")), t.events.groupBy(F.col("user_id").alias("iid")).agg(F.count("*").alias("events"))], "iid")


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)")
def align_left_merge(spark, d):
    t = Tables(spark, d)
    return t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")


@query("SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def align_inner_merge(spark, d):
    t = Tables(spark, d)
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")


@query("SELECT doc_id, coalesce(q2, quality) AS quality FROM (SELECT doc_id AS l_id, 1 - quality AS q2 FROM labels WHERE doc_id % 3 = 0) RIGHT JOIN labels ON l_id = doc_id")
def align_right_coalesce(spark, d):
    labels = Tables(spark, d).labels
    first = labels.where("doc_id % 3 = 0").select("doc_id", (1 - F.col("quality")).alias("q2"))
    return first.join(labels, "doc_id", "right").select("doc_id", F.coalesce("q2", "quality").alias("quality"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)")
def align_anti(spark, d):
    t = Tables(spark, d)
    return t.customer.join(t.orders.where("o_totalprice > 490000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def align_semi(spark, d):
    t = Tables(spark, d)
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT r_name, n FROM region CROSS JOIN (SELECT unnest(range(4)) AS n)")
def align_grid(spark, d):
    return Tables(spark, d).region.select("r_name").crossJoin(F.broadcast(spark.range(4).withColumnRenamed("id", "n")))


_REF = "(SELECT p_partkey AS ref_idx, p_size AS chr, p_partkey // 2 AS bp, substr('ACGT', CAST(1 + p_partkey % 4 AS INTEGER), 1) AS a1, substr('CGTA', CAST(1 + p_partkey % 4 AS INTEGER), 1) AS a2 FROM part)"
_STUDY = "(SELECT ref_idx * 10 AS study_idx, chr, bp, CASE WHEN ref_idx % 3 = 0 THEN a2 ELSE a1 END AS a1, CASE WHEN ref_idx % 3 = 0 THEN a1 ELSE a2 END AS a2 FROM " + _REF + " WHERE ref_idx % 5 <> 0)"


def _reference(t: Tables):
    return t.part.selectExpr("p_partkey as ref_idx", "p_size as chr", "p_partkey div 2 as bp", "substr('ACGT', cast(1 + p_partkey % 4 as int), 1) as a1", "substr('CGTA', cast(1 + p_partkey % 4 as int), 1) as a2")


def _study(t: Tables):
    return _reference(t).where("ref_idx % 5 != 0").selectExpr("ref_idx * 10 as study_idx", "chr", "bp", "if(ref_idx % 3 = 0, a2, a1) as a1", "if(ref_idx % 3 = 0, a1, a2) as a2")


_MAPPED = f"""SELECT ref_idx, coalesce(study_idx, -1) AS study_idx, coalesce(flip, 0) AS flip FROM (
    SELECT r.ref_idx, s.study_idx, CASE WHEN s.a1 = r.a1 THEN 1 WHEN s.a1 IS NOT NULL THEN -1 END AS flip,
    row_number() OVER (PARTITION BY ref_idx ORDER BY CASE WHEN s.a1 = r.a1 THEN 0 WHEN s.a1 IS NOT NULL THEN 1 ELSE 2 END, study_idx) AS n
    FROM {_REF} r LEFT JOIN {_STUDY} s ON r.chr = s.chr AND r.bp = s.bp AND ((r.a1 = s.a1 AND r.a2 = s.a2) OR (r.a1 = s.a2 AND r.a2 = s.a1))) WHERE n = 1"""


@query(_MAPPED)
def mapper_match(spark, d):
    t = Tables(spark, d)
    return align.match_variants(_study(t), _reference(t))


@query(f"SELECT flip, count(*) AS n, sum(CASE WHEN flip = -1 THEN 2 - g ELSE g END) AS total FROM (SELECT *, ref_idx % 3 AS g FROM ({_MAPPED})) GROUP BY flip")
def mapper_flip_dosage(spark, d):
    t = Tables(spark, d)
    m = align.match_variants(_study(t), _reference(t)).withColumn("g", align.flip_dosage(F.col("ref_idx") % 3, F.col("flip")))
    return m.groupBy("flip").agg(F.count("*").alias("n"), F.sum("g").alias("total"))


@query(f"SELECT ref_idx FROM ({_MAPPED}) WHERE study_idx = -1")
def mapper_not_in_study(spark, d):
    t = Tables(spark, d)
    return align.match_variants(_study(t), _reference(t)).where("study_idx = -1").select("ref_idx")


@query("SELECT p_partkey, b.id AS brand, t.id AS type FROM part JOIN (SELECT p_brand AS v, min(p_partkey) AS id FROM part GROUP BY 1) b ON p_brand = b.v JOIN (SELECT p_type AS v, min(p_partkey) AS id FROM part GROUP BY 1) t ON p_type = t.v")
def mapper_dictionary_decode(spark, d):
    p = Tables(spark, d).part
    codes = lambda c: p.groupBy(F.col(c).alias(c)).agg(F.min("p_partkey").alias(c[2:]))
    return p.join(codes("p_brand"), "p_brand").join(codes("p_type"), "p_type").select("p_partkey", "brand", "type")


@query("SELECT p_partkey, abs(p_retailprice / 2000 - (p_size / 50.0)) > 0.2 AS outlier FROM part")
def mapper_frequency_outliers(spark, d):
    return Tables(spark, d).part.select("p_partkey", (F.abs(F.col("p_retailprice") / 2000 - F.col("p_size") / 50.0) > 0.2).alias("outlier"))


@query(f"SELECT s.event_id AS snp, c.event_id AS cpg, s.pos - c.pos AS apart FROM {_POS} s JOIN {_POS} c ON s.chr = c.chr AND abs(s.pos - c.pos) <= 1800")
def cis_range_join(spark, d):
    p = _positions(Tables(spark, d))
    sites = p.select(F.col("event_id").alias("cpg"), "chr", F.col("pos").alias("site"))
    return ranges.near_join(p.withColumnRenamed("event_id", "snp"), sites, "chr", "pos", "site", 1800).select("snp", "cpg", (F.col("pos") - F.col("site")).alias("apart"))


@query(f"SELECT e.event_id, i.event_id AS span FROM {_POS} e JOIN (SELECT event_id, chr, pos AS start, pos + 500 + event_id % 1000 AS stop FROM {_POS}) i ON e.chr = i.chr AND e.pos BETWEEN start - 150 AND stop + 150")
def interval_overlap(spark, d):
    p = _positions(Tables(spark, d))
    spans = p.selectExpr("event_id as span", "chr", "pos as start", "pos + 500 + event_id % 1000 as stop")
    return ranges.inside_join(p, spans, "chr", "pos", "start", "stop", 150, 2000).select("event_id", "span")


@query(f"SELECT c.event_id AS cpg, min(v.value) AS least FROM {_POS} c JOIN {_POS} s ON s.chr = c.chr AND s.pos > c.pos - 3600 AND s.pos < c.pos + 3600 JOIN events v ON v.event_id = s.event_id GROUP BY 1")
def window_min(spark, d):
    e = Tables(spark, d).events
    p = e.select(F.col("event_type").alias("chr"), F.unix_timestamp("ts").alias("pos"), "value", F.col("event_id").alias("cpg"))
    near = p.select("cpg", "chr", "pos").join(ranges.least_within(p, "chr", "pos", "value", 3600), ["chr", "pos"])
    return near.groupBy("cpg").agg(F.min("least").alias("least"))


@query("SELECT a.l_orderkey, a.l_linenumber, round(abs(a.l_discount - b.l_tax), 4) AS gap FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE abs(a.l_discount - b.l_tax) > 0.075")
def align_compare_results(spark, d):
    li = Tables(spark, d).lineitem
    b = li.select("l_orderkey", "l_linenumber", "l_tax")
    gap = F.abs(F.col("l_discount") - F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", "l_discount").join(b, ["l_orderkey", "l_linenumber"]).where(gap > 0.075).select("l_orderkey", "l_linenumber", F.round(gap, 4).alias("gap"))


@query("SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 50000")
def align_result_info(spark, d):
    t = Tables(spark, d)
    return t.orders.where("o_totalprice > 50000").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


@query("SELECT event_id, coalesce(n, -1) AS n FROM events LEFT JOIN (SELECT c_custkey, c_nationkey AS n FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey")
def align_name_join(spark, d):
    t = Tables(spark, d)
    c = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n"))
    return t.events.join(c, "user_id", "left").select("event_id", F.coalesce("n", F.lit(-1)).alias("n"))


@query("SELECT label, max_by(vec_id, embedding[1]) AS top FROM embeddings GROUP BY label")
def align_top_hit(spark, d):
    e = Tables(spark, d).embeddings
    w = Window.partitionBy("label").orderBy(F.desc(F.col("embedding")[0]), "vec_id")
    return e.withColumn("n", F.row_number().over(w)).where("n = 1").select("label", F.col("vec_id").alias("top"))
