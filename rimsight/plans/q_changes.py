"""Snapshots, upserts, searches and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimsight.operators import changes, keyed
from rimsight.plans.registry import query
from rimsight.plans.standins import table
from rimsight.session import scratch_path
from rimsight.streaming import upsert

# two overlapping snapshots: everything before a late day, everything from an early day on
LATE, EARLY = "2001-01-01", "1996-01-01"
SNAP = f"""snap AS (SELECT o_orderkey AS id, 'Team ' || o_custkey AS team, CASE WHEN o_totalprice > 100000 THEN 'Player ' || o_orderkey END AS name,
    CASE o_orderstatus WHEN 'F' THEN 'In' ELSE 'Out' END AS status, o_orderpriority AS year, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
old AS (SELECT * FROM snap WHERE day < '{LATE}'), new AS (SELECT * FROM snap WHERE day >= '{EARLY}')"""


def snapshots(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Team "), F.col("o_custkey").cast("string")).alias("team"),
        F.when(F.col("o_totalprice") > 100000, F.concat(F.lit("Player "), F.col("o_orderkey").cast("string"))).alias("name"),
        F.when(F.col("o_orderstatus") == "F", "In").otherwise("Out").alias("status"),
        F.col("o_orderpriority").alias("year"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    return orders.where(F.col("day") < LATE), orders.where(F.col("day") >= EARLY)


KEY = ["team", "name", "status"]
DIFF = (
    SNAP
    + """, ok AS (SELECT DISTINCT coalesce(team, '') AS a, coalesce(name, '') AS b, coalesce(status, '') AS c FROM old),
nk AS (SELECT DISTINCT coalesce(team, '') AS a, coalesce(name, '') AS b, coalesce(status, '') AS c FROM new),
diff AS (SELECT *, 'added' AS change FROM new n WHERE NOT EXISTS (SELECT 1 FROM ok WHERE a = n.team AND b = coalesce(n.name, '') AND c = n.status)
  UNION ALL SELECT *, 'removed' FROM old o WHERE NOT EXISTS (SELECT 1 FROM nk WHERE a = o.team AND b = coalesce(o.name, '') AND c = o.status))"""
)


@query("u7_snapshot_diff", f"WITH {DIFF} SELECT * FROM diff")
def u7(spark, d):
    return changes.snapshot_diff(*snapshots(spark, d), KEY)


@query(
    "u8_change_summary",
    f"""WITH {DIFF}, n AS (SELECT count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'removed') AS removed FROM diff),
    f AS (SELECT * FROM diff WHERE change = 'added' ORDER BY id LIMIT 5)
    SELECT added, removed, 'transfers added: ' || (SELECT string_agg(coalesce(name, '?') || ' (' || team || ', ' || status || ')', ', ' ORDER BY id) FROM f)
      || ' + ' || (added - 5) || ' more; ' || removed || ' transfers removed' AS summary FROM n""",
)
def u8(spark, d):
    label = F.concat(F.coalesce("name", F.lit("?")), F.lit(" ("), "team", F.lit(", "), "status", F.lit(")"))
    diff = changes.snapshot_diff(*snapshots(spark, d), KEY)
    return changes.change_summary(diff, label, ["id"], "transfers")


@query(
    "u6_symmetric_difference",
    f"""WITH {SNAP} SELECT id, 'left' AS side FROM old WHERE id NOT IN (SELECT id FROM new)
    UNION ALL SELECT id, 'right' FROM new WHERE id NOT IN (SELECT id FROM old)""",
)
def u6(spark, d):
    return changes.symmetric_difference(*snapshots(spark, d), "id")


@query(
    "u5_append_missing",
    f"""WITH {SNAP}, e AS (SELECT DISTINCT team AS college, 'x' AS ncaa_id, 'Clean ' || team AS college_clean FROM old)
    SELECT * FROM e UNION ALL SELECT DISTINCT trim(team), '', trim(team) FROM new WHERE trim(team) NOT IN (SELECT college FROM e)""",
)
def u5(spark, d):
    old, new = snapshots(spark, d)
    existing = old.select(F.col("team").alias("college")).distinct().withColumn("ncaa_id", F.lit("x"))
    existing = existing.withColumn("college_clean", F.concat(F.lit("Clean "), "college"))
    seen = new.select(F.concat(F.lit(" "), "team").alias("college"))
    return changes.append_missing(existing, seen, "college", {"ncaa_id": F.lit(""), "college_clean": F.col("college")})


@query(
    "u1_union_all",
    f"WITH {SNAP} SELECT team, name, status, NULL AS note FROM old UNION ALL SELECT team, name, NULL, day FROM new",
)
def u1(spark, d):
    old, new = snapshots(spark, d)
    return old.select("team", "name", "status").unionByName(
        new.select("team", "name", F.col("day").alias("note")), allowMissingColumns=True
    )


@query("u2_distinct_rows", f"WITH {SNAP} SELECT DISTINCT team, status, year FROM new")
def u2(spark, d):
    return snapshots(spark, d)[1].select("team", "status", "year").distinct()


CREW8 = ["day", "l_quantity", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "half"]
CREW8_SQL = """e AS (SELECT strftime(l_shipdate, '%Y') AS day, l_quantity, l_linenumber, l_discount > 0.05 AS l_discount, l_tax > 0.04 AS l_tax,
    l_returnflag, l_linestatus, l_suppkey % 2 AS half, l_orderkey * 1000000000 + l_partkey AS ord FROM lineitem)"""


def crew8(spark, d):
    return table(spark, d, "lineitem").select(
        F.date_format("l_shipdate", "yyyy").alias("day"),
        "l_quantity",
        "l_linenumber",
        (F.col("l_discount") > 0.05).alias("l_discount"),
        (F.col("l_tax") > 0.04).alias("l_tax"),
        "l_returnflag",
        "l_linestatus",
        (F.col("l_suppkey") % 2).alias("half"),
        (F.col("l_orderkey") * 1000000000 + F.col("l_partkey")).alias("ord"),
    )


@query(
    "u3_first_wins_dedupe",
    f"WITH {CREW8_SQL} SELECT {', '.join(CREW8)}, min(ord) AS ord FROM e GROUP BY ALL",
    "l_quantity",
)
def u3(spark, d):
    return keyed.first_per_key(crew8(spark, d), CREW8, [F.col("ord")])


@query(
    "u3_duplicates_removed",
    f"WITH {CREW8_SQL} SELECT count(*) AS total, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(CREW8)} FROM e)) AS removed FROM e",
)
def u3_removed(spark, d):
    sizes = crew8(spark, d).groupBy(*CREW8).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("total"), (F.sum("n") - F.count(F.lit(1))).alias("removed"))


@query(
    "u4_distinct_keep_first",
    "SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY 1",
)
def u4(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return keyed.first_per_key(orders, ["o_custkey"], [F.col("o_orderkey")])


@query(
    "u10_coach_dedupe",
    """SELECT lower(p_name) AS k1, lower(p_brand) AS k2, lower(p_type) AS k3, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2, 3""",
)
def u10(spark, d):
    # every second row is spelled in capitals, so only the lowered keys agree
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    spelled = part.withColumn("p_name", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")))
    lowered = spelled.select(F.lower("p_name").alias("k1"), F.lower("p_brand").alias("k2"), F.lower("p_type").alias("k3"), "p_partkey")
    return keyed.first_per_key(lowered, ["k1", "k2", "k3"], [F.col("p_partkey")])


UPS = f"""both_ AS (SELECT id, team, name, status, 1 AS batch FROM old UNION ALL SELECT id, team || '*', name, 'Moved', 2 FROM new)"""


@query(
    "k3_keyed_upsert",
    f"""WITH {SNAP}, {UPS} SELECT id, arg_max(team, batch) AS team, arg_max(coalesce(name, '-'), batch) AS name,
      arg_max(status, batch) AS status, CAST(max(batch) AS BIGINT) AS batch FROM both_ GROUP BY 1""",
)
def k3(spark, d):
    old, new = snapshots(spark, d)
    name = F.coalesce("name", F.lit("-")).alias("name")
    current = old.select("id", "team", name, "status", F.lit(1).alias("batch"))
    incoming = new.select("id", F.concat("team", F.lit("*")).alias("team"), name, F.lit("Moved").alias("status"), F.lit(2).alias("batch"))
    return keyed.upsert(current, incoming, ["id"], "batch")


@query(
    "k3_incremental_upsert",
    f"""WITH {SNAP}, b AS (SELECT *, 0 AS batch FROM old UNION ALL SELECT id, team, name, 'Moved', year, day, 1 FROM new WHERE id % 97 = 0)
    SELECT id, arg_max(team, batch) AS team, arg_max(status, batch) AS status FROM b GROUP BY 1""",
)
def k3_incremental(spark, d):
    """A whole snapshot, then a batch that touches some of the table's key buckets."""
    old, new = snapshots(spark, d)
    path = scratch_path(spark, "upserts")
    apply = upsert.upsert_batch(path, ["id"], "day", buckets=32)
    columns = ["id", "team", "status", "day"]
    apply(old.select(*columns), 0)
    apply(new.where("id % 97 = 0").withColumn("status", F.lit("Moved")).select(*columns), 1)
    return upsert.current(spark, path).select("id", "team", "status")


@query(
    "k3_composite_key_upsert",
    f"""WITH {SNAP}, b AS (SELECT team, status, year, day, id FROM old UNION ALL SELECT team, status, year, day, id FROM new)
    SELECT team, status, arg_max(year, row(day, id)) AS year, arg_max(id, row(day, id)) AS id FROM b GROUP BY 1, 2""",
)
def k3_pair(spark, d):
    old, new = snapshots(spark, d)
    columns = ["team", "status", "year", "id", "day"]
    both = old.select(*columns).unionByName(new.select(*columns))
    return keyed.last_per_key(both, ["team", "status"], [F.col("day"), F.col("id")]).drop("day")


@query(
    "k3_row_hash_upsert",
    f"""WITH {SNAP}, b AS (SELECT team, status FROM old UNION ALL SELECT team, status FROM new)
    SELECT sha1('{{"team":"' || team || '","status":"' || status || '"}}') AS id, team, status FROM b GROUP BY ALL""",
)
def k3_hash(spark, d):
    old, new = snapshots(spark, d)
    both = old.select("team", "status").unionByName(new.select("team", "status"))
    hashed = both.withColumn("id", keyed.row_hash(both, ["team", "status"]))
    return keyed.last_per_key(hashed, ["id"], [F.col("team")])


@query(
    "p7_transfer_search",
    f"""WITH {SNAP} SELECT id, team, name, status, year FROM new WHERE status = 'In' AND upper(year) = '2-HIGH'
      AND contains(lower(coalesce(name, '') || ' ' || team || ' ' || day), 'player 1')""",
)
def p7(spark, d):
    new = snapshots(spark, d)[1]
    found = changes.search(new, "Player 1", ["name", "team", "day"], {"status": "In", "year": "2-high"}, any_case=["year"])
    return found.select("id", "team", "name", "status", "year")


@query(
    "p8_coaching_search",
    f"""WITH {SNAP} SELECT id, team, name, status, year FROM old WHERE status = 'Out'
      AND contains(lower(team || ' ' || coalesce(name, '') || ' ' || year || ' ' || day), 'team 12')""",
)
def p8(spark, d):
    old = snapshots(spark, d)[0]
    found = changes.search(old, "TEAM 12", ["team", "name", "year", "day"], {"status": "Out", "year": None})
    return found.select("id", "team", "name", "status", "year")


@query("p9_facet_values", "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '' ORDER BY 1")
def p9(spark, d):
    return changes.facet_values(table(spark, d, "orders"), "o_orderpriority")


@query(
    "p10_pick_rows",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 40",
)
def p10(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return changes.pick_rows(
        orders, "o_orderpriority", ["1-URGENT", "5-LOW"], shuffle_by=F.md5(F.col("o_orderkey").cast("string")), limit=40
    )


@query(
    "p10_demo_rows",
    "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 5",
)
def p10_demo(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return changes.pick_rows(orders, "o_orderpriority", shuffle_by=F.md5(F.col("o_orderkey").cast("string")), limit=40, demo=True)


@query(
    "t8_fixed_batches",
    f"""WITH {SNAP}, s AS (SELECT id FROM old WHERE id NOT IN (SELECT id FROM new) UNION ALL SELECT id FROM new WHERE id NOT IN (SELECT id FROM old))
    SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 100) AS BIGINT) AS batch FROM s""",
)
def t8(spark, d):
    ids = changes.symmetric_difference(*snapshots(spark, d), "id").select("id")
    return changes.batches(ids, "id", 100)
