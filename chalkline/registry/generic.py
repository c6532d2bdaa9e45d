"""Operators on the star-schema tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.functions import exprs as x
from chalkline.operators import analytics, joins, mastery, quality, responses
from chalkline.operators.ordered import Scan, ordered_scan
from chalkline.operators.unify import Source, one_per_value, project, shared_values, unify
from chalkline.registry.base import query, rounded
from chalkline.registry.model import Model

EVENT_BANDS = ((200.0, "Exceeding"), (150.0, "Meeting"), (120.0, "Developing"))

_BAND = """CASE WHEN {c} >= 200 THEN 'Exceeding' WHEN {c} >= 150 THEN 'Meeting'
    WHEN {c} >= 120 THEN 'Developing' ELSE 'Needs Intervention' END"""

_BEST = f"""
    SELECT event_id, user_id, event_type, ts, value, max_score_to_date, assessment_count,
           {_BAND.format(c='max_score_to_date')} AS mastery_level
    FROM (SELECT *, max(value) OVER w AS max_score_to_date, count(*) OVER w AS assessment_count FROM events
          WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts NULLS LAST, event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r"""


def _events(m: Model) -> DataFrame:
    return m.t["events"].select("event_id", "user_id", "event_type", "ts", "value")


def event_best(m: Model) -> DataFrame:
    return mastery.running_best(_events(m), ["user_id", "event_type"], "ts", "value", ["event_id"], EVENT_BANDS)


# --- running and latest -----------------------------------------------------------


@query(
    "running_best_mastery",
    f"""SELECT event_id, user_id, event_type, value, max_score_to_date, assessment_count, mastery_level FROM ({_BEST}) b""",
)
def running_best_mastery(m: Model) -> DataFrame:
    return event_best(m).drop("ts")


_LINES = ("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@query(
    "running_best_hot_groups",
    """SELECT l_returnflag, '' || CAST(l_shipdate AS DATE) AS day, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
              max(l_quantity) OVER w AS best, CAST(sum(l_linenumber) OVER w AS BIGINT) AS running_lines, count(*) OVER w AS seen,
              lag(l_quantity) OVER w0 AS previous, count(*) OVER (PARTITION BY l_returnflag) AS total
       FROM lineitem
       WINDOW w AS (PARTITION BY l_returnflag
                    ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              w0 AS (PARTITION BY l_returnflag
                     ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice)""",
)
def running_best_hot_groups(m: Model) -> DataFrame:
    """Three groups of a third of the table each, cut into slices."""
    rows = m.t["lineitem"].select("l_returnflag", "l_quantity", F.col("l_linenumber").cast("bigint").alias("line"), *_LINES)
    scan = Scan(
        running_max={"best": "l_quantity"},
        running_sum={"running_lines": "line"},
        running_count="seen",
        previous={"previous": "l_quantity"},
        group_size="total",
    )
    out = ordered_scan(rows, ["l_returnflag"], list(_LINES), scan, hot_rows=1000)
    return out.withColumn("day", F.col("l_shipdate").cast("date").cast("string")).drop("l_shipdate", "l_quantity", "line")


@query(
    "latest_per_key",
    """SELECT user_id, event_type, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) r
       WHERE rn = 1""",
)
def latest_per_key(m: Model) -> DataFrame:
    return mastery.latest_per_key(_events(m), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "rows_at_latest_date",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders JOIN
         (SELECT o_custkey AS k, max(o_orderdate) AS d FROM orders GROUP BY o_custkey) t
       ON o_custkey = k AND o_orderdate = d""",
)
def rows_at_latest_date(m: Model) -> DataFrame:
    rows = m.t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return mastery.rows_at_latest(rows, ["o_custkey"], "o_orderdate").drop("o_orderdate")


@query(
    "previous_value_per_key",
    """SELECT event_id, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS previous FROM events""",
)
def previous_value_per_key(m: Model) -> DataFrame:
    scan = Scan(previous={"previous": "value"})
    return ordered_scan(_events(m), ["user_id", "event_type"], ["ts", "event_id"], scan).select("event_id", "previous")


@query(
    "position_and_group_size",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position,
              count(*) OVER (PARTITION BY user_id) AS size FROM events""",
)
def position_and_group_size(m: Model) -> DataFrame:
    scan = Scan(running_count="position", group_size="size")
    return ordered_scan(_events(m), ["user_id"], ["ts", "event_id"], scan).select("event_id", "position", "size")


@query(
    "longest_streak_below",
    """SELECT user_id, event_type, max(run) AS longest_streak FROM (
         SELECT user_id, event_type, island, count(*) FILTER (WHERE miss = 0) AS run FROM (
           SELECT user_id, event_type, miss, sum(miss) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id
                                                            ROWS UNBOUNDED PRECEDING) AS island
           FROM (SELECT *, CASE WHEN value < 50 THEN 0 ELSE 1 END AS miss FROM events) a) b
         GROUP BY user_id, event_type, island) c
       GROUP BY user_id, event_type""",
)
def longest_streak_below(m: Model) -> DataFrame:
    return mastery.longest_streak(_events(m), ["user_id", "event_type"], ["ts", "event_id"], F.col("value") < 50)


@query(
    "halves_trend",
    f"""SELECT user_id, round(avg(CASE WHEN rn <= total / 2 THEN max_score_to_date END), 9) AS early_avg,
               round(avg(CASE WHEN rn > total / 2 THEN max_score_to_date END), 9) AS recent_avg
        FROM (SELECT user_id, max_score_to_date, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
                     count(*) OVER (PARTITION BY user_id) AS total FROM ({_BEST}) b) r
        WHERE total >= 2 GROUP BY user_id""",
)
def halves_trend(m: Model) -> DataFrame:
    return rounded(mastery.halves_trend(event_best(m), "user_id", ["ts", "event_id"]), "early_avg", "recent_avg")


@query(
    "last_three_against_first_three",
    f"""SELECT user_id, round(avg(CASE WHEN assessment_count <= 3 THEN max_score_to_date END), 9) AS early_avg,
               round(avg(CASE WHEN assessment_count >= top - 2 THEN max_score_to_date END), 9) AS recent_avg
        FROM (SELECT *, max(assessment_count) OVER (PARTITION BY user_id) AS top FROM ({_BEST}) b) r GROUP BY user_id""",
)
def last_three_against_first_three(m: Model) -> DataFrame:
    return rounded(mastery.ends_trend(event_best(m), "user_id"), "early_avg", "recent_avg")


@query(
    "early_warning_users",
    f"""WITH best AS ({_BEST}),
          latest AS (SELECT user_id, event_type, max(value) AS best FROM events GROUP BY ALL),
          summary AS (SELECT user_id, avg(best) AS a, count(*) FILTER (WHERE best < 120) AS below, count(*) AS n
                      FROM latest GROUP BY user_id),
          halves AS (SELECT user_id, avg(CASE WHEN rn <= total / 2 THEN max_score_to_date END) AS early,
                            avg(CASE WHEN rn > total / 2 THEN max_score_to_date END) AS recent
                     FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type, assessment_count) AS rn,
                                  count(*) OVER (PARTITION BY user_id) AS total FROM best) r
                     WHERE total >= 2 GROUP BY user_id),
          rates AS (SELECT o_custkey AS user_id, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS rate
                    FROM orders GROUP BY o_custkey)
        SELECT user_id, round(a, 9) AS avg_mastery_score, round(coalesce(rate, 1.0), 9) AS attendance_rate,
               below AS count_below_developing, n AS standards_assessed, coalesce(recent < early, false) AS declining_trend,
               CASE WHEN below >= 3 AND coalesce(rate, 1.0) < 0.3 THEN 'High'
                    WHEN below >= 2 OR coalesce(rate, 1.0) < 0.3 THEN 'Medium' ELSE 'Low' END AS risk_level
        FROM summary LEFT JOIN halves USING (user_id) LEFT JOIN rates USING (user_id)""",
)
def early_warning_users(m: Model) -> DataFrame:
    """The early-warning operator under other column names, thresholds and statuses."""
    best = event_best(m).withColumnRenamed("value", "score")
    seen = m.t["orders"].select(F.col("o_custkey").alias("user_id"), "o_orderstatus")
    out = mastery.early_warning(
        best,
        seen,
        entity="user_id",
        item="event_type",
        date="ts",
        status="o_orderstatus",
        present="F",
        below=120.0,
        floor=0.30,
    )
    return rounded(out, "avg_mastery_score", "attendance_rate")


# --- expressions ----------------------------------------------------------------------


@query(
    "normalized_grades",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 9 WHEN '3-MEDIUM' THEN 12
              WHEN '4-NOT SPECIFIED' THEN CAST(o_custkey % 13 AS INTEGER) END AS grade,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'Kindergarten' WHEN '2-HIGH' THEN 'Grade 9' WHEN '3-MEDIUM' THEN 'Grade 12'
              WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_custkey % 13 = 0 THEN 'Kindergarten' ELSE 'Grade ' || (o_custkey % 13) END
              END AS label FROM orders""",
)
def normalized_grades(m: Model) -> DataFrame:
    """Words in any case, digits, and text that is neither."""
    p = F.col("o_orderpriority")
    raw = (
        F.when(p == "1-URGENT", F.lit("KINDERgarten"))
        .when(p == "2-HIGH", F.lit("Freshman"))
        .when(p == "3-MEDIUM", F.lit("senior"))
        .when(p == "4-NOT SPECIFIED", F.lpad((F.col("o_custkey") % 13).cast("string"), 2, "0"))
        .otherwise(F.lit("Grade 6"))
    )
    graded = m.t["orders"].select("o_orderkey", x.normalize_grade(raw).alias("grade"))
    return graded.withColumn("label", x.grade_label("grade"))


@query(
    "codes_and_titles",
    """SELECT p_partkey, split_part(p_type || '-' || p_brand, '-', 2) AS second, split_part(p_type, '-', 3) AS third,
              CASE WHEN contains(p_name, 'widget') THEN 'widget' WHEN contains(p_name, 'ring') THEN 'ring' ELSE 'Unknown' END AS kind,
              TRY_CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS number,
              TRY_CAST(regexp_extract(p_name, '([0-9]+)$', 1) AS INTEGER) AS no_number,
              upper(regexp_replace(trim(p_brand || ' ' || p_name), '[^A-Za-z0-9]+', '.', 'g')) AS dotted
       FROM part""",
)
def codes_and_titles(m: Model) -> DataFrame:
    joined = F.concat_ws("-", "p_type", "p_brand")
    return m.t["part"].select(
        "p_partkey",
        x.code_part(joined, 2).alias("second"),
        x.code_part("p_type", 3).alias("third"),
        x.subject_of("p_name", ("widget", "ring")).alias("kind"),
        x.trailing_number("p_brand").alias("number"),
        x.trailing_number("p_name").alias("no_number"),
        x.dotted_code(F.concat_ws(" ", "p_brand", "p_name")).alias("dotted"),
    )


@query(
    "hashes_raw_and_canonical",
    """SELECT c_custkey, sha256(c_name) AS raw, sha256(lower(trim('  ' || c_name || ' '))) AS canonical,
              sha256(CASE WHEN c_acctbal > 0 THEN c_mktsegment END) AS maybe FROM customer""",
)
def hashes_raw_and_canonical(m: Model) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    return m.t["customer"].select(
        "c_custkey",
        x.hashed("c_name").alias("raw"),
        x.hashed(padded, canonical=True).alias("canonical"),
        x.hashed(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).alias("maybe"),
    )


@query(
    "bands_and_risk",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
              CASE WHEN l_quantity * 2 >= 90 THEN 'Exceeding' WHEN l_quantity * 2 >= 70 THEN 'Meeting'
                   WHEN l_quantity * 2 >= 50 THEN 'Developing' ELSE 'Needs Intervention' END AS level,
              CASE WHEN l_linenumber >= 3 AND 1 - l_discount < 0.93 THEN 'High'
                   WHEN l_linenumber >= 2 OR 1 - l_discount < 0.93 THEN 'Medium' ELSE 'Low' END AS risk
       FROM lineitem""",
)
def bands_and_risk(m: Model) -> DataFrame:
    return m.t["lineitem"].select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        x.mastery_level(F.col("l_quantity") * 2).alias("level"),
        x.risk_level("l_linenumber", 1 - F.col("l_discount"), floor=0.93).alias("risk"),
    )


@query(
    "lenient_casts",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS number,
              CASE WHEN o_orderstatus <> 'O' THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
              CAST(CASE WHEN month(o_orderdate) >= 8 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS school_year
       FROM orders""",
)
def lenient_casts(m: Model) -> DataFrame:
    """Text that does not parse becomes NULL instead of stopping the job."""
    status = F.col("o_orderstatus")
    number = F.when(status == "F", F.col("o_totalprice").cast("string")).otherwise(F.lit("n/a"))
    day = F.when(status != "O", F.col("o_orderdate").cast("date").cast("string")).otherwise(F.lit("soon"))
    return m.t["orders"].select(
        "o_orderkey",
        number.try_cast("double").alias("number"),
        x.birth_year(day).alias("year"),
        x.school_year("o_orderdate").alias("school_year"),
    )


@query(
    "answers_compared",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CASE WHEN l_quantity < 5 THEN NULL ELSE l_returnflag = 'A' END AS is_correct,
              coalesce(CASE WHEN l_quantity < 5 THEN NULL ELSE l_returnflag = 'A' END, false) AS known_correct
       FROM lineitem""",
)
def answers_compared(m: Model) -> DataFrame:
    given = F.when(F.col("l_quantity") >= 5, F.col("l_returnflag"))
    return m.t["lineitem"].select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        (given == "A").alias("is_correct"),
        F.coalesce(given == "A", F.lit(False)).alias("known_correct"),
    )


# --- unions and projections --------------------------------------------------------------


@query(
    "two_sources_unified",
    """SELECT 'C' || c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS term,
              'customers' AS _source_system FROM customer
       UNION ALL
       SELECT 'S' || s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END, NULL, 'suppliers'
       FROM supplier WHERE s_nationkey < 20""",
)
def two_sources_unified(m: Model) -> DataFrame:
    """Different shapes and types: text balances that do not parse become NULL, missing columns a typed NULL."""
    text = F.when(F.col("s_acctbal") < 0, F.lit("debt")).otherwise(F.col("s_acctbal").cast("string"))

    def prefixed(letter: str, key: str):
        return F.concat(F.lit(letter), F.col(key).cast("string"))

    return unify(
        [
            Source(
                m.t["customer"],
                {
                    "id": prefixed("C", "c_custkey"),
                    "name": "c_name",
                    "balance": "c_acctbal",
                    "term": None,
                    "_source_system": F.lit("customers"),
                },
            ),
            Source(
                m.t["supplier"],
                {
                    "id": prefixed("S", "s_suppkey"),
                    "name": "s_name",
                    "balance": text,
                    "term": None,
                    "_source_system": F.lit("suppliers"),
                },
                F.col("s_nationkey") < 20,
            ),
        ],
        types={"balance": "double"},
    )


@query("projected_and_dropped", "SELECT p_partkey AS id, p_name AS title, 'catalog' AS origin FROM part")
def projected_and_dropped(m: Model) -> DataFrame:
    renamed = project(m.t["part"], {"id": "p_partkey", "title": "p_name", "brand": "p_brand", "origin": F.lit("catalog")})
    return renamed.drop("brand")


@query(
    "values_shared_between_sources",
    """SELECT sha256(text) AS hash, count(DISTINCT source) AS sources, count(*) AS rows FROM documents WHERE text IS NOT NULL
       GROUP BY text HAVING count(DISTINCT source) > 1""",
)
def values_shared_between_sources(m: Model) -> DataFrame:
    """Hashed first, so that no text is shuffled."""
    return shared_values(m.t["documents"].select(x.hashed("text").alias("hash"), "source"), "hash", "source")


@query(
    "one_row_per_hash",
    """SELECT sha256(text) AS hash, doc_id, source FROM (
         SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) r WHERE rn = 1""",
)
def one_row_per_hash(m: Model) -> DataFrame:
    rows = m.t["documents"].select(x.hashed("text").alias("hash"), "doc_id", "source")
    return one_per_value(rows, "hash", ["doc_id"])


# --- joins ----------------------------------------------------------------------------------


@query(
    "left_lookup",
    """SELECT n_nationkey, n_name, r_name, coalesce(CASE WHEN n_nationkey < 10 THEN 'own' END, r_name) AS filled
       FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey > 1) r ON n_regionkey = r_regionkey""",
)
def left_lookup(m: Model) -> DataFrame:
    own = F.when(F.col("n_nationkey") < 10, F.lit("own"))
    left = m.t["nation"].select("n_nationkey", "n_name", "n_regionkey", own.alias("filled"))
    regions = m.t["region"].filter("r_regionkey > 1").withColumn("filled", F.col("r_name"))
    return joins.enrich(left, regions, {"n_regionkey": "r_regionkey"}, ["r_name"], fill=["filled"]).drop("n_regionkey")


@query(
    "fan_out_left_join",
    """SELECT c_custkey, o_orderkey, o_totalprice FROM
         (SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS c_custkey FROM customer) c
       LEFT JOIN orders o ON c_custkey = o_custkey""",
)
def fan_out_left_join(m: Model) -> DataFrame:
    left = m.t["customer"].select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("c_custkey"))
    return joins.fan_out(left, m.t["orders"], {"c_custkey": "o_custkey"}, ["o_orderkey", "o_totalprice"])


@query(
    "orphans_with_null_keys",
    """SELECT l_orderkey, l_linenumber, l_suppkey, key FROM (
         SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_tax > 0 THEN l_partkey END AS key FROM lineitem) l
       WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = key AND p_size <= 40)""",
)
def orphans_with_null_keys(m: Model) -> DataFrame:
    key = F.when(F.col("l_tax") > 0, F.col("l_partkey")).alias("key")
    rows = m.t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey", key)
    return joins.orphans(rows, m.t["part"].filter("p_size <= 40"), {"key": "p_partkey"})


@query(
    "orphans_without_null_keys",
    """SELECT DISTINCT key, l_returnflag FROM (
         SELECT l_returnflag, CASE WHEN l_tax > 0 THEN l_partkey END AS key FROM lineitem) l
       WHERE key IS NOT NULL AND key NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)""",
)
def orphans_without_null_keys(m: Model) -> DataFrame:
    key = F.when(F.col("l_tax") > 0, F.col("l_partkey")).alias("key")
    rows = m.t["lineitem"].select(key, "l_returnflag").distinct()
    return joins.orphans(rows, m.t["part"].filter("p_size <= 40"), {"key": "p_partkey"}, null_is_orphan=False)


@query(
    "rows_below_band",
    """SELECT l_orderkey, l_linenumber, l_quantity, p_size, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_quantity < p_size""",
)
def rows_below_band(m: Model) -> DataFrame:
    rows = m.t["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
    return joins.below_band(rows, m.t["part"], {"l_partkey": "p_partkey"}, "l_quantity", "p_size", ["p_name"]).drop("l_partkey")


_PATTERNS = """(SELECT l_linestatus AS s, l_returnflag AS f, 'pattern ' || l_returnflag AS label, 'note ' || l_linestatus AS note
    FROM lineitem GROUP BY ALL)"""


@query(
    "tagged_with_patterns",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag = 'N' AS is_correct, label AS tag, note
        FROM lineitem LEFT JOIN {_PATTERNS} p ON l_linestatus = s AND l_returnflag = f AND l_returnflag <> 'N'""",
)
def tagged_with_patterns(m: Model) -> DataFrame:
    lines = m.t["lineitem"].withColumn("expected", F.lit("N"))
    patterns = (
        m.t["lineitem"]
        .select(F.col("l_linestatus").alias("s"), F.col("l_returnflag").alias("f"))
        .distinct()
        .select(
            "s",
            "f",
            F.concat(F.lit("pattern "), F.col("f")).alias("label"),
            F.concat(F.lit("note "), F.col("s")).alias("note"),
        )
    )
    rows = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "expected")
    tagged = responses.tag_with_patterns(
        rows, patterns, {"l_linestatus": "s", "l_returnflag": "f"}, "expected", "l_returnflag", {"tag": "label", "note": "note"}
    )
    return tagged.drop("l_linestatus", "l_returnflag", "expected")


@query(
    "prerequisite_ancestors",
    """WITH RECURSIVE e AS (SELECT p_partkey AS c, p_partkey // 2 AS p FROM part WHERE p_partkey > 0),
         t(item, ancestor, depth) AS (SELECT c, p, 1 FROM e UNION ALL
           SELECT t.item, e.p, t.depth + 1 FROM t JOIN e ON t.ancestor = e.c)
       SELECT item, ancestor, depth FROM t""",
)
def prerequisite_ancestors(m: Model) -> DataFrame:
    """Every part under the part of half its number, up to the root."""
    half = F.when(F.col("p_partkey") > 0, F.expr("p_partkey div 2")).alias("needs")
    return analytics.ancestors(m.t["part"].select("p_partkey", half), "p_partkey", "needs")


# --- aggregates, filters, order --------------------------------------------------------------


@query(
    "conditional_aggregates",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 9) AS avg_quantity,
              count(*) FILTER (WHERE l_discount > 0.05) AS discounted, count(DISTINCT l_suppkey) AS suppliers,
              round(avg(CASE WHEN l_tax > 0.04 THEN l_extendedprice END), 4) AS taxed_price,
              round(avg(CASE WHEN l_quantity >= 25 THEN 1.0 ELSE 0.0 END), 9) AS large_share,
              round(count(*) FILTER (WHERE l_linenumber = 1) / nullif(count(*), 0), 9) AS first_lines
       FROM lineitem GROUP BY ALL""",
)
def conditional_aggregates(m: Model) -> DataFrame:
    grouped = m.t["lineitem"].groupBy("l_returnflag", "l_linestatus")
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("l_quantity"), 9).alias("avg_quantity"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.round(F.avg(F.when(F.col("l_tax") > 0.04, F.col("l_extendedprice"))), 4).alias("taxed_price"),
        F.round(x.share_of(F.col("l_quantity") >= 25), 9).alias("large_share"),
        F.round(x.ratio(F.count_if(F.col("l_linenumber") == 1), F.count(F.lit(1))), 9).alias("first_lines"),
    )


@query(
    "nullable_group_keys",
    """SELECT CASE WHEN p_size < 10 THEN NULL ELSE p_type END AS kind, p_brand, max(p_retailprice) AS top, count(*) AS n
       FROM part GROUP BY ALL""",
)
def nullable_group_keys(m: Model) -> DataFrame:
    kind = F.when(F.col("p_size") >= 10, F.col("p_type")).alias("kind")
    return m.t["part"].groupBy(kind, "p_brand").agg(F.max("p_retailprice").alias("top"), F.count(F.lit(1)).alias("n"))


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrence_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(m: Model) -> DataFrame:
    return quality.duplicates(m.t["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    "null_keys_by_source",
    """SELECT l_returnflag, count(*) AS null_count FROM lineitem WHERE l_tax <= 0 GROUP BY l_returnflag""",
)
def null_keys_by_source(m: Model) -> DataFrame:
    keyed = m.t["lineitem"].select("l_returnflag", F.when(F.col("l_tax") > 0, F.col("l_partkey")).alias("key"))
    return keyed.filter(F.col("key").isNull()).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("null_count"))


@query(
    "future_rows",
    "SELECT o_orderkey, '' || CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2001-01-01'",
)
def future_rows(m: Model) -> DataFrame:
    day = F.col("o_orderdate").cast("date").alias("day")
    rows = m.t["orders"].select("o_orderkey", day).filter(F.col("day") > F.lit("2001-01-01").cast("date"))
    return rows.withColumn("day", F.col("day").cast("string"))


@query(
    "composed_filters",
    """SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7""",
)
def composed_filters(m: Model) -> DataFrame:
    chosen = analytics.filtered(m.t["customer"], c_mktsegment="BUILDING", c_nationkey=7, c_name="All")
    return chosen.select("c_custkey", "c_name")


@query(
    "cascading_options",
    """SELECT DISTINCT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' ORDER BY n_name""",
)
def cascading_options(m: Model) -> DataFrame:
    places = joins.lookup(m.t["nation"], m.t["region"], {"n_regionkey": "r_regionkey"}, ["r_name"])
    return analytics.options(places, "n_name", r_name="ASIA")


@query(
    "top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def top_orders(m: Model) -> DataFrame:
    return analytics.top_rows(m.t["orders"].select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


@query("rows_per_table", " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS rows FROM {t}""" for t in _TABLES))
def rows_per_table(m: Model) -> DataFrame:
    return analytics.row_counts({name: m.t[name] for name in _TABLES})


@query(
    "comparison_by_region",
    """SELECT event_type, r_name, count(DISTINCT user_id) AS student_count, round(avg(best), 9) AS avg_score,
              round(avg(CASE WHEN best >= 150 THEN 1.0 ELSE 0.0 END), 9) AS mastery_pct, event_type || '!' AS label
       FROM (SELECT user_id, event_type, max(value) AS best FROM events GROUP BY ALL) e
       JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN orders ON o_custkey = c_custkey GROUP BY event_type, r_name""",
)
def comparison_by_region(m: Model) -> DataFrame:
    """Users in regions, weighted by their orders."""
    latest = mastery.latest_mastery(event_best(m), ["user_id", "event_type"], EVENT_BANDS, score="value")
    places = joins.lookup(m.t["nation"], m.t["region"], {"n_regionkey": "r_regionkey"}, ["r_name"])
    homes = joins.lookup(m.t["customer"], places, {"c_nationkey": "n_nationkey"}, ["r_name"])
    rows = joins.lookup(m.t["orders"].select("o_custkey"), homes, {"o_custkey": "c_custkey"}, ["r_name"])
    kinds = m.t["events"].select("event_type").distinct().withColumn("label", F.concat(F.col("event_type"), F.lit("!")))
    out = mastery.group_comparison(
        latest,
        rows.withColumnRenamed("o_custkey", "user_id"),
        kinds,
        entity="user_id",
        item="event_type",
        groups=("r_name",),
        item_take=("label",),
    )
    return rounded(out, "avg_score", "mastery_pct")
