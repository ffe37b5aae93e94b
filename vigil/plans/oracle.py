"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the pre-registered views (``lineitem``, ``orders``,
``embeddings``, ``documents`` …). The iterative queries (Lloyd steps, online
updates) are unrolled into CTE chains generated here.
"""

from __future__ import annotations

import re

from vigil.plans.catalog import (
    ANOMALY_RANK,
    BATCH_TICKS,
    CENTRES_K,
    LLOYD_ITERATIONS,
    ONE_HOT_ITERATIONS,
    ONE_HOT_KS,
    ONLINE_DECAY_BATCHES,
    ONLINE_DECAY_POINTS,
    ONLINE_WEIGHT,
    RANDOM_CENTRES,
    RAW_KS,
    SEED,
    STREAM_BATCHES,
    SWEEP_ITERATIONS,
    SWEEP_KS,
    TOP_ANOMALIES,
    Z_KS,
)

R = """r AS (
  SELECT o_orderstatus AS label, l_quantity AS q, l_returnflag AS c1, l_linestatus AS c2,
         CAST(l_linenumber AS VARCHAR) AS c3, l_extendedprice AS e, l_discount AS d,
         l_tax AS t
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

E = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
u AS (SELECT vec_id, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS x FROM e)"""


def _first_k(name: str, k: int) -> str:
    return f"""{name} AS (
  SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, f
  FROM (SELECT vec_id, f FROM e ORDER BY vec_id LIMIT {k}))"""


def _assign(name: str, centres: str) -> str:
    return f"""{name} AS (
  SELECT e.vec_id, any_value(e.label) AS label,
         CAST(arg_min(c.cluster, list_distance(e.f, c.f)) AS INTEGER) AS cluster,
         min(list_distance(e.f, c.f)) AS distance
  FROM e, {centres} c GROUP BY e.vec_id)"""


def _lloyd_ctes(prefix: str, k: int, iterations: int) -> tuple[list[str], str]:
    """CTEs for ``iterations`` Lloyd steps from the first k rows; returns the
    CTE list and the name of the final centres CTE (cluster, f)."""
    ctes = [_first_k(f"{prefix}c0", k)]
    for it in range(iterations):
        c, a, s, n, nxt = (f"{prefix}{x}{it}" for x in ("c", "a", "s", "n", "c"))
        nxt = f"{prefix}c{it + 1}"
        ctes.append(_assign(a, c))
        ctes.append(f"""{s} AS (
  SELECT a.cluster, u.dim, sum(u.x) / count(*) AS x
  FROM {a} a JOIN u USING (vec_id) GROUP BY a.cluster, u.dim)""")
        ctes.append(f"""{n} AS (SELECT cluster, list(x ORDER BY dim) AS f FROM {s} GROUP BY cluster)""")
        ctes.append(f"""{nxt} AS (
  SELECT c.cluster, coalesce(n.f, c.f) AS f FROM {c} c LEFT JOIN {n} n USING (cluster))""")
    return ctes, f"{prefix}c{iterations}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _centres_c5() -> str:
    return _first_k("c5", CENTRES_K)


# --- records ---------------------------------------------------------------------

LABEL_HISTOGRAM = _with(R) + """
SELECT label, count(*) AS cnt FROM r GROUP BY label ORDER BY cnt DESC, label"""

PARSE_NUMERIC = _with(R) + """
SELECT label, q AS f0, e AS f1, d AS f2, t AS f3 FROM r"""

CATEGORY_DICTIONARY = _with(R, """pairs AS (
  SELECT DISTINCT 1 AS field, c1 AS category FROM r
  UNION SELECT DISTINCT 2, c2 FROM r
  UNION SELECT DISTINCT 3, c3 FROM r)""") + """
SELECT CAST(field AS INTEGER) AS field, category,
       CAST(dense_rank() OVER (PARTITION BY field ORDER BY category) - 1 AS INTEGER) AS idx
FROM pairs"""

_DICTS = """d1 AS (SELECT list_sort(list_distinct(list(c1))) AS cats FROM r),
d2 AS (SELECT list_sort(list_distinct(list(c2))) AS cats FROM r),
d3 AS (SELECT list_sort(list_distinct(list(c3))) AS cats FROM r)"""

_ONE_HOT = """fe AS (
  SELECT r.*, list_concat(
      [r.q],
      list_transform(d1.cats, lambda x: CASE WHEN x = r.c1 THEN 1.0 ELSE 0.0 END),
      list_transform(d2.cats, lambda x: CASE WHEN x = r.c2 THEN 1.0 ELSE 0.0 END),
      list_transform(d3.cats, lambda x: CASE WHEN x = r.c3 THEN 1.0 ELSE 0.0 END),
      [r.e, r.d, r.t]) AS f
  FROM r, d1, d2, d3)"""

ONE_HOT_FEATURES = _with(R, _DICTS, _ONE_HOT, """fu AS (
  SELECT label, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS x FROM fe)""") + """
SELECT label, CAST(dim AS INTEGER) AS dim, round(sum(x), 2) AS total FROM fu GROUP BY label, dim"""

ONE_HOT_SPARSE = _with(R, _DICTS, _ONE_HOT, """fu AS (
  SELECT label, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS x FROM fe)""") + """
SELECT label, CAST(dim AS INTEGER) AS dim, x, count(*) AS cnt FROM fu WHERE x <> 0 GROUP BY label, dim, x"""

_R_NUM = """num AS (
  SELECT label, 0 AS dim, q AS x FROM r UNION ALL SELECT label, 1, e FROM r
  UNION ALL SELECT label, 2, d FROM r UNION ALL SELECT label, 3, t FROM r)"""

COLUMN_STATS = _with(R, _R_NUM) + """
SELECT CAST(dim AS INTEGER) AS dim, count(x) AS n, round(avg(x), 4) AS mean,
       round(stddev_pop(x), 4) AS sd_pop
FROM num GROUP BY dim"""

PARSE_VECTORS = _with(R) + "SELECT q AS f0, e AS f1, d AS f2, t AS f3 FROM r"
COLUMN_MOMENTS = _with(R, _R_NUM) + """
SELECT CAST(dim AS INTEGER) AS dim, count(x) AS n, round(sum(x), 2) AS total, round(sum(x * x), -4) AS squares
FROM num GROUP BY dim"""


def _scaled(sd: str) -> str:
    cols = []
    for i, c in enumerate(("q", "e", "d", "t")):
        s = f"{sd}({c}) OVER ()"
        cols.append(f"round(CASE WHEN {s} <= 0 THEN {c} - avg({c}) OVER () "
                    f"ELSE ({c} - avg({c}) OVER ()) / {s} END, 6) AS z{i}")
    return _with(R) + "SELECT label, " + ", ".join(cols) + " FROM r"


ZSCORE = _scaled("stddev_pop")


def _standard_scale() -> str:
    # pyspark.ml StandardScaler: sample sd; a zero-variance dimension gives 0.
    cols = []
    for i, c in enumerate(("q", "e", "d", "t")):
        s = f"stddev_samp({c}) OVER ()"
        cols.append(f"round(CASE WHEN {s} = 0 THEN 0.0 "
                    f"ELSE ({c} - avg({c}) OVER ()) / {s} END, 6) AS z{i}")
    return _with(R) + "SELECT label, " + ", ".join(cols) + " FROM r"


STANDARD_SCALE = _standard_scale()

# --- embeddings with the C5 centres ---------------------------------------------------

_A5 = _with(E, _centres_c5(), _assign("a", "c5"))

ASSIGN_CLUSTERS = _A5 + "SELECT vec_id, cluster FROM a"
DISTANCE_TO_CENTROID = _A5 + "SELECT vec_id, cluster, round(distance, 6) AS distance FROM a"
CLUSTERING_SCORE = _A5 + "SELECT round(avg(distance), 6) AS score FROM a"
CLUSTER_LABEL_COUNTS = _A5 + """
SELECT cluster, label, count(*) AS cnt FROM a GROUP BY cluster, label ORDER BY cluster, label"""

_ENTROPY_OF = """
SELECT round(sum(n * h) / sum(n), 6) AS {col} FROM (
  SELECT cluster, sum(c) AS n,
         -sum((c / t) * ln(c / t)) AS h
  FROM (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS c,
               CAST(sum(count(*)) OVER (PARTITION BY cluster) AS DOUBLE) AS t
        FROM {src} GROUP BY cluster, label) GROUP BY cluster)"""

WEIGHTED_ENTROPY = _A5 + _ENTROPY_OF.format(col="entropy", src="a")

KTH_LARGEST = _A5 + f"""
SELECT round(min(distance), 6) AS threshold
FROM (SELECT distance FROM a ORDER BY distance DESC LIMIT {ANOMALY_RANK})"""

PRECISION_BY_THRESHOLD = _A5 + """
, g AS (SELECT round(distance, 6) AS threshold, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS tp,
               count(*) AS n
        FROM a GROUP BY 1)
SELECT threshold,
       round(sum(tp) OVER w / sum(n) OVER w, 6) AS precision
FROM g WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
ORDER BY threshold DESC"""


def _lloyd3() -> str:
    ctes, final = _lloyd_ctes("l", CENTRES_K, LLOYD_ITERATIONS)
    return _with(E, *ctes) + f"""
SELECT cluster, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS dim,
       round(unnest(f), 6) AS value FROM {final}"""


LLOYD_3 = _lloyd3()


def _sweep(score_sql: str) -> str:
    ctes, parts = [], []
    for k in SWEEP_KS:
        lc, final = _lloyd_ctes(f"k{k}_", k, LLOYD_ITERATIONS)
        ctes += lc + [_assign(f"k{k}_fin", final)]
        parts.append(f"SELECT {k} AS k, ({score_sql.format(src=f'k{k}_fin')}) AS score")
    body = "\nUNION ALL\n".join(parts)
    return _with(E, *ctes) + f"SELECT CAST(k AS INTEGER) AS k, round(score, 6) AS score FROM (\n{body})"


SWEEP_K = _sweep("SELECT avg(distance) FROM {src}")
SWEEP_K_ENTROPY = _sweep(
    "SELECT sum(n * h) / sum(n) FROM (SELECT cluster, sum(c) AS n, -sum((c / t) * ln(c / t)) AS h "
    "FROM (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS c, "
    "CAST(sum(count(*)) OVER (PARTITION BY cluster) AS DOUBLE) AS t "
    "FROM {src} GROUP BY cluster, label) GROUP BY cluster)")

RANDOM_PROJECTION = _with(E, """m AS (
  SELECT dim, sin(3 * dim + 1) AS a, sin(3 * dim + 2) AS b, sin(3 * dim + 3) AS c,
         sqrt(sin(3 * dim + 1) ^ 2 + sin(3 * dim + 2) ^ 2 + sin(3 * dim + 3) ^ 2) AS nrm
  FROM (SELECT DISTINCT dim FROM u))""") + """
SELECT vec_id, round(sum(x * a / nrm), 6) AS x, round(sum(x * b / nrm), 6) AS y,
       round(sum(x * c / nrm), 6) AS z
FROM u JOIN m USING (dim) GROUP BY vec_id"""



def _normal(row: str, column: str) -> str:
    """The seeded normal number of a cell."""
    digest = f"md5('{SEED}|' || CAST({row} AS BIGINT) || '|' || CAST({column} AS BIGINT))"
    u = f"((CAST('0x' || substr({digest}, 1, 8) AS BIGINT) + 0.5) / 4294967296.0)"
    return f"sqrt(-2 * ln(CAST({u} AS DOUBLE))) * cos(2 * pi() * CAST('0x' || substr({digest}, 9, 8) AS BIGINT) / 4294967296.0)"


RANDOM_PROJECTION_SEEDED = _with(E, f"""g AS (
  SELECT dim, {_normal('dim', '0')} AS a, {_normal('dim', '1')} AS b, {_normal('dim', '2')} AS c FROM (SELECT DISTINCT dim FROM u))""",
  "m AS (SELECT *, sqrt(a * a + b * b + c * c) AS nrm FROM g)") + """
SELECT vec_id, round(sum(x * a / nrm), 6) AS x, round(sum(x * b / nrm), 6) AS y,
       round(sum(x * c / nrm), 6) AS z
FROM u JOIN m USING (dim) GROUP BY vec_id"""
CLUSTER_COUNT = _A5 + "SELECT count(DISTINCT cluster) AS n_clusters FROM a"

# --- anomalies -------------------------------------------------------------------

_GROUP_MEANS = [
    """r AS (
  SELECT concat_ws(',', CAST(l_quantity AS VARCHAR), l_returnflag, l_linestatus,
                   CAST(l_linenumber AS VARCHAR), CAST(l_extendedprice AS VARCHAR),
                   CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), o_orderstatus) AS value,
         l_quantity AS q, l_returnflag AS c1, l_linestatus AS c2,
         CAST(l_linenumber AS VARCHAR) AS c3, l_extendedprice AS e, l_discount AS d,
         l_tax AS t, o_orderstatus AS label, row_number() OVER () AS rid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    _DICTS, _ONE_HOT,
    """fu AS (SELECT rid, c1, c2, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS v FROM fe)""",
    """st AS (SELECT dim, avg(v) AS m, stddev_pop(v) AS s FROM fu GROUP BY dim)""",
    """z AS (
  SELECT fu.rid, fu.c1, fu.c2, fu.dim,
         CASE WHEN st.s <= 0 THEN fu.v - st.m ELSE (fu.v - st.m) / st.s END AS z
  FROM fu JOIN st USING (dim))""",
    """cen AS (SELECT c1 AS g1, c2 AS g2, dim, avg(z) AS cz FROM z GROUP BY c1, c2, dim)""",
    """dist AS (
  SELECT z.rid, cen.g1, cen.g2, sqrt(sum((z.z - cen.cz) * (z.z - cen.cz))) AS dd
  FROM z JOIN cen USING (dim) GROUP BY z.rid, cen.g1, cen.g2)""",
]

DETECT_ANOMALIES = _with(
    *_GROUP_MEANS,
    """best AS (SELECT rid, min(dd) AS distance FROM dist GROUP BY rid)""",
    f"""thr AS (SELECT min(distance) AS t FROM
  (SELECT distance FROM best ORDER BY distance DESC LIMIT {ANOMALY_RANK}))""",
) + """
SELECT r.value, round(b.distance, 6) AS distance
FROM best b JOIN r USING (rid), thr WHERE b.distance > thr.t"""

TOP_ANOMALIES_SQL = DETECT_ANOMALIES + f" ORDER BY b.distance DESC LIMIT {TOP_ANOMALIES}"

_NUMBERED = """numbered AS (SELECT g1, g2, CAST(row_number() OVER (ORDER BY g1, g2) - 1 AS INTEGER) AS cluster,
  CAST(row_number() OVER (ORDER BY g1 DESC, g2 DESC) - 1 AS INTEGER) AS reversed FROM (SELECT DISTINCT g1, g2 FROM cen))"""
STREAM_SAVED_MODEL = _with(
    *_GROUP_MEANS, _NUMBERED,
    f"""nearest AS (SELECT rid, arg_min(CASE WHEN CAST(c3 AS INTEGER) % {STREAM_BATCHES} = 0 THEN cluster ELSE reversed END, dd) AS cluster
  FROM dist JOIN numbered USING (g1, g2) JOIN (SELECT rid, c3 FROM r) USING (rid) GROUP BY rid)""",
) + f"""
SELECT CAST(c3 AS INTEGER) % {STREAM_BATCHES} AS batch_id, CAST(c3 AS INTEGER) % {STREAM_BATCHES} = 0 AS first_model, cluster, label, count(*) AS cnt
FROM nearest JOIN r USING (rid) GROUP BY ALL"""
STREAM_NEW_FILES = _with(R) + f"""
SELECT CAST(c3 AS INTEGER) % {STREAM_BATCHES} AS batch, label, count(*) AS cnt, round(sum(q), 2) AS total
FROM r WHERE CAST(c3 AS INTEGER) % {STREAM_BATCHES} > 0 GROUP BY ALL"""

APPLY_SAVED_MODEL = _with(
    *_GROUP_MEANS,
    """numbered AS (SELECT g1, g2, CAST(row_number() OVER (ORDER BY g1, g2) - 1 AS INTEGER) AS cluster
  FROM (SELECT DISTINCT g1, g2 FROM cen))""",
    """nearest AS (SELECT rid, arg_min(cluster, dd) AS cluster FROM dist JOIN numbered USING (g1, g2) GROUP BY rid)""",
) + "SELECT cluster, label, count(*) AS cnt FROM nearest JOIN r USING (rid) GROUP BY cluster, label"

# --- many models in one scan -----------------------------------------------------------

_R_VALUE = _GROUP_MEANS[0]
_NUM_VECTORS = """fu AS (SELECT rid, generate_subscripts([q, e, d, t], 1) - 1 AS dim, unnest([q, e, d, t]) AS v FROM r)"""
_Z_STATS = _GROUP_MEANS[4]
_Z_CELLS = """zc AS (SELECT fu.rid, fu.dim, CASE WHEN st.s <= 0 THEN fu.v - st.m ELSE (fu.v - st.m) / st.s END AS z
  FROM fu JOIN st USING (dim))"""
_Z_ONE_HOT = (_R_VALUE, _DICTS, _ONE_HOT, """fu AS (SELECT rid, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS v FROM fe)""",
              _Z_STATS, _Z_CELLS, "v AS (SELECT rid, list(z ORDER BY dim) AS f FROM zc GROUP BY rid)")


def _many_lloyd(start: str, iterations: int) -> list[str]:
    """Lloyd steps of the models of CTE ``start`` (k, cluster, f) on v (rid, f); the last
    assignment is ``fin`` (k, rid, cluster, distance), the centres ``cn``."""
    ctes = [f"cn0 AS ({start})"]
    for it in range(iterations + 1):
        ctes.append(f"""an{it} AS (SELECT c.k, v.rid, CAST(arg_min(c.cluster, list_distance(v.f, c.f)) AS INTEGER) AS cluster,
          min(list_distance(v.f, c.f)) AS distance FROM v, cn{it} c GROUP BY c.k, v.rid)""")
        if it < iterations:
            ctes.append(f"""sn{it} AS (SELECT a.k, a.cluster, u.dim, avg(u.x) AS x FROM an{it} a
              JOIN (SELECT rid, generate_subscripts(f, 1) AS dim, unnest(f) AS x FROM v) u USING (rid) GROUP BY ALL)""")
            ctes.append(f"""cn{it + 1} AS (SELECT c.k, c.cluster, coalesce(n.f, c.f) AS f FROM cn{it} c
              LEFT JOIN (SELECT k, cluster, list(x ORDER BY dim) AS f FROM sn{it} GROUP BY k, cluster) n USING (k, cluster))""")
    ctes += [f"fin AS (SELECT * FROM an{iterations})", f"cn AS (SELECT * FROM cn{iterations})"]
    return ctes


def _seeded(ks) -> str:
    """The first k of the records whose md5 comes first, for each k."""
    return f"""SELECT k, CAST(i AS INTEGER) AS cluster, f FROM (SELECT unnest({list(ks)}) AS k),
      (SELECT row_number() OVER (ORDER BY md5(value)) - 1 AS i, f FROM (
        SELECT value, any_value(v.f) AS f FROM r JOIN v USING (rid) GROUP BY value ORDER BY md5(value) LIMIT {max(ks)})) WHERE i < k"""


_MEAN_DISTANCE = "SELECT CAST(k AS INTEGER) AS k, round(avg(distance), 6) AS score FROM fin GROUP BY k"
SWEEP_RECORDS_RAW = _with(_R_VALUE, "v AS (SELECT rid, [q, e, d, t] AS f FROM r)", *_many_lloyd(_seeded(RAW_KS), SWEEP_ITERATIONS)) + _MEAN_DISTANCE
SWEEP_RECORDS_Z = _with(_R_VALUE, _NUM_VECTORS, _Z_STATS, _Z_CELLS, "v AS (SELECT rid, list(z ORDER BY dim) AS f FROM zc GROUP BY rid)",
                        *_many_lloyd(_seeded(Z_KS), SWEEP_ITERATIONS)) + _MEAN_DISTANCE
SWEEP_RECORDS_ONE_HOT = _with(*_Z_ONE_HOT, *_many_lloyd(_seeded(ONE_HOT_KS), ONE_HOT_ITERATIONS)) + _MEAN_DISTANCE
SWEEP_RECORDS_ENTROPY = _with(*_Z_ONE_HOT, *_many_lloyd(_seeded(ONE_HOT_KS), ONE_HOT_ITERATIONS)) + """
SELECT CAST(k AS INTEGER) AS k, round(sum(n * h) / sum(n), 6) AS score FROM (
  SELECT k, cluster, sum(c) AS n, -sum((c / t) * ln(c / t)) AS h FROM (
    SELECT k, cluster, label, CAST(count(*) AS DOUBLE) AS c, CAST(sum(count(*)) OVER (PARTITION BY k, cluster) AS DOUBLE) AS t
    FROM fin JOIN r USING (rid) GROUP BY k, cluster, label) GROUP BY k, cluster) GROUP BY k"""

_RUN_STARTS = "\nUNION ALL\n".join(
    f"""SELECT {i} AS k, CAST(row_number() OVER (ORDER BY g) - 1 AS INTEGER) AS cluster, f FROM (
      SELECT g, list(x ORDER BY dim) AS f FROM (SELECT {c} AS g, dim, avg(z) AS x FROM zc JOIN r USING (rid) GROUP BY {c}, dim) GROUP BY g)"""
    for i, c in enumerate(("c1", "c2", "c3")))
KMEANS_MANY_RUNS = _with(*_Z_ONE_HOT, *_many_lloyd(_RUN_STARTS, LLOYD_ITERATIONS), """
cost AS (SELECT k AS run, avg(distance * distance) AS cost FROM fin GROUP BY k)""") + """
SELECT CAST(run AS INTEGER) AS run, CAST(max(cluster) OVER (PARTITION BY run) + 1 AS INTEGER) AS k, round(cost, 6) AS cost,
       cost = (SELECT min(cost) FROM cost) AS best, cluster, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value
FROM (SELECT run, cost, cluster, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS value FROM cn JOIN cost ON k = run)"""

# What every fit must satisfy.
KMEANS_FIT = _with(E) + """
SELECT CAST(sum(CASE WHEN dim = 0 THEN n END) AS BIGINT) AS rows, true AS at_most_k, round(sum(n * v), 3) AS total_ss
FROM (SELECT dim, count(*) AS n, var_pop(x) AS v FROM u GROUP BY dim)"""
BUILD_MODEL = _with(R) + "SELECT count(*) AS rows, true AS at_most_k, true AS stored FROM r"
ANOMALIES_KMEANS = _with(R) + "SELECT count(*) AS records, true AS few, true AS above, true AS ranked FROM r"
PROFILE_CLUSTERS = _with(R) + "SELECT label, count(*) AS cnt, count(*) AS clustered FROM r GROUP BY label"
# the first eight hex digits below 0.05 * 2^32 = 0x0ccccccc.cc
SAMPLE_ASSIGNMENTS = _A5 + """
SELECT a.cluster, round(e.f[1], 6) AS f0, round(e.f[2], 6) AS f1, round(e.f[3], 6) AS f2
FROM a JOIN e USING (vec_id) WHERE substr(md5('1|' || vec_id), 1, 8) <= '0ccccccc'"""
SAMPLE_FITTED = _with(E) + """
SELECT true AS nearest, round(f[1], 6) AS f0, round(f[2], 6) AS f1, round(f[3], 6) AS f2
FROM e WHERE substr(md5('1|' || vec_id), 1, 8) <= '0ccccccc'"""


# --- online k-means ----------------------------------------------------------------

def _online_ctes(discount_sql: str) -> list[str]:
    return [
        _centres_c5(),
        _assign("a", "c5"),
        """s AS (SELECT a.cluster, u.dim, sum(u.x) AS s, count(*) AS m
      FROM a JOIN u USING (vec_id) GROUP BY a.cluster, u.dim)""",
        """cu AS (SELECT cluster, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS c FROM c5)""",
        f"""upd AS (
  SELECT cu.cluster, cu.dim,
         CAST({ONLINE_WEIGHT} * ({discount_sql}) + coalesce(s.m, 0) AS DOUBLE) AS w,
         CASE WHEN coalesce(s.m, 0) > 0
              THEN (1 - s.m / ({ONLINE_WEIGHT} * ({discount_sql}) + s.m)) * cu.c
                   + (s.m / ({ONLINE_WEIGHT} * ({discount_sql}) + s.m)) / s.m * s.s
              ELSE cu.c END AS v
  FROM cu LEFT JOIN s USING (cluster, dim))""",
    ]


def _online_update(discount_sql: str) -> str:
    return _with(E, *_online_ctes(discount_sql)) + """
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim,
       round(v, 6) AS value, round(w, 6) AS weight FROM upd"""


ONLINE_UPDATE = _online_update(str(ONLINE_DECAY_BATCHES))
ONLINE_UPDATE_POINTS = _online_update(
    f"pow({ONLINE_DECAY_POINTS}, (SELECT count(*) FROM e))")

ONLINE_SCORE = _with(
    E, *_online_ctes(str(ONLINE_DECAY_BATCHES)),
    """nc AS (SELECT cluster, list(v ORDER BY dim) AS f FROM upd GROUP BY cluster)""",
    _assign("a2", "nc"),
) + "SELECT round(avg(distance), 6) AS score FROM a2"

ONLINE_CROSSTAB = _with(
    E, *_online_ctes(str(ONLINE_DECAY_BATCHES)),
    """nc AS (SELECT cluster, list(v ORDER BY dim) AS f FROM upd GROUP BY cluster)""",
    _assign("a2", "nc"),
) + "SELECT cluster, label, count(*) AS cnt FROM a2 GROUP BY cluster, label"

# weights start at 0: a centre with rows becomes their mean; then the smallest weight, if it
# is below 1e-8 of the largest, and the largest share the largest's rows and place
ONLINE_RANDOM_START = _with(
    E,
    f"""start AS (SELECT CAST(c AS INTEGER) AS cluster, list({_normal('c', 'dim')} ORDER BY dim) AS f
  FROM range({RANDOM_CENTRES}) t(c), (SELECT DISTINCT dim FROM u) GROUP BY c)""",
    _assign("a", "start"),
    "n AS (SELECT s.cluster, count(a.vec_id) AS m FROM start s LEFT JOIN a USING (cluster) GROUP BY s.cluster)",
    """means AS (SELECT a.cluster, u.dim, avg(u.x) AS x FROM a JOIN u USING (vec_id) GROUP BY a.cluster, u.dim)""",
    """cells AS (SELECT cluster, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS c FROM start)""",
    """upd AS (SELECT cluster, dim, CAST(m AS DOUBLE) AS w, coalesce(x, c) AS v FROM cells JOIN n USING (cluster) LEFT JOIN means USING (cluster, dim))""",
    """ends AS (SELECT arg_max(cluster, (m, -cluster)) AS big, arg_min(cluster, (m, cluster)) AS small, max(m) AS hi, min(m) AS lo FROM n)""",
    "largest AS (SELECT dim, v, 1e-14 * greatest(abs(v), 1.0) AS p FROM upd, ends WHERE cluster = big)",
) + """
SELECT cluster, CAST(dim AS INTEGER) AS dim,
       round(CASE WHEN lo >= 1e-8 * hi OR cluster NOT IN (big, small) THEN upd.v WHEN cluster = big THEN l.v + l.p ELSE l.v - l.p END, 6) AS value,
       round(CASE WHEN lo >= 1e-8 * hi OR cluster NOT IN (big, small) THEN w ELSE (hi + lo) / 2 END, 6) AS weight
FROM upd JOIN largest l USING (dim), ends"""


# --- streaming -----------------------------------------------------------------------

def _stream_ctes(decay: float = 1.0, ticks=tuple(range(STREAM_BATCHES))) -> list[str]:
    ctes = [
        _centres_c5(),
        f"""eb AS (SELECT e.*, CAST(floor(vec_id * {STREAM_BATCHES}
                 / ((SELECT max(vec_id) FROM e) + 1)) AS INTEGER) AS b FROM e)""",
        """st0 AS (SELECT cluster, f, CAST(0.0 AS DOUBLE) AS w FROM c5)""",
    ]
    for b in range(STREAM_BATCHES):
        ctes += [
            f"""ab{b} AS (
  SELECT eb.vec_id, CAST(arg_min(c.cluster, list_distance(eb.f, c.f)) AS INTEGER) AS cluster
  FROM eb, st{b} c WHERE eb.b = {b} GROUP BY eb.vec_id)""",
            f"""sb{b} AS (SELECT a.cluster, u.dim, sum(u.x) AS s, CAST(count(*) AS DOUBLE) AS m
  FROM ab{b} a JOIN u USING (vec_id) GROUP BY a.cluster, u.dim)""",
            f"""ub{b} AS (
  SELECT cu.cluster, cu.dim, cu.w + coalesce(s.m, 0) AS w,
         CASE WHEN coalesce(s.m, 0) > 0
              THEN (1 - s.m / greatest(cu.w + s.m, 1e-16)) * cu.c
                   + (s.m / greatest(cu.w + s.m, 1e-16)) / s.m * s.s
              ELSE cu.c END AS v
  FROM (SELECT cluster, w * {decay ** (ticks[b] - ticks[b - 1] if b else 1)} AS w, generate_subscripts(f, 1) - 1 AS dim, unnest(f) AS c FROM st{b}) cu
  LEFT JOIN sb{b} s USING (cluster, dim))""",
            f"""st{b + 1} AS (SELECT cluster, list(v ORDER BY dim) AS f, any_value(w) AS w
  FROM ub{b} GROUP BY cluster)""",
            f"""pb{b} AS (
  SELECT eb.vec_id, any_value(eb.label) AS label,
         CAST(arg_min(c.cluster, list_distance(eb.f, c.f)) AS INTEGER) AS cluster,
         min(list_distance(eb.f, c.f)) AS distance
  FROM eb, st{b + 1} c WHERE eb.b = {b} GROUP BY eb.vec_id)""",
        ]
    return ctes


def _union(template: str) -> str:
    return "\nUNION ALL\n".join(template.format(b=b) for b in range(STREAM_BATCHES))


STREAM_KMEANS = _with(E, *_stream_ctes()) + _union(
    "SELECT {b} AS batch_id, CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim, "
    "round(v, 6) AS value FROM ub{b}")

STREAM_CENTERS = _with(E, *_stream_ctes()) + _union(
    "SELECT {b} AS batch_id, 'before' AS phase, CAST(cluster AS INTEGER) AS cluster, "
    "CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS dim, round(unnest(f), 6) AS value, "
    "round(w, 6) AS weight FROM st{b} "
    "UNION ALL SELECT {b}, 'after', CAST(cluster AS INTEGER), CAST(dim AS INTEGER), "
    "round(v, 6), round(w, 6) FROM ub{b}")

STREAM_CLUSTER_LABEL_COUNTS = _with(E, *_stream_ctes()) + _union(
    "SELECT {b} AS batch_id, cluster, label, count(*) AS cnt FROM pb{b} GROUP BY cluster, label")

STREAM_MEAN_DISTANCE = _with(E, *_stream_ctes()) + _union(
    "SELECT {b} AS batch_id, round(avg(distance), 6) AS mean_distance FROM pb{b}")

STREAM_IDLE_TICKS = _with(E, *_stream_ctes(ONLINE_DECAY_BATCHES, BATCH_TICKS)) + _union(
    "SELECT {b} AS batch_id, CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim, "
    "round(v, 6) AS value, round(w, 6) AS weight FROM ub{b}")

STREAM_WRITE_ASSIGNMENTS = _A5 + f"""
SELECT CAST(floor(vec_id * {STREAM_BATCHES} / ((SELECT max(vec_id) FROM e) + 1)) AS INTEGER) AS batch_id, a.cluster,
       round(e.f[1], 6) AS f0, round(e.f[2], 6) AS f1, round(e.f[3], 6) AS f2
FROM a JOIN e USING (vec_id)"""

STREAM_PREDICT = ASSIGN_CLUSTERS

STREAM_WORD_COUNT = f"""
SELECT CAST(floor(doc_id * {STREAM_BATCHES} / ((SELECT max(doc_id) FROM documents) + 1)) AS INTEGER) AS batch_id,
       word, count(*) AS cnt
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY ALL"""


def _positive_zero(sql: str) -> str:
    """Add +0.0 to every rounded value: DuckDB's round can return -0.0 for a
    tiny negative, Spark's never does, and -0.0 + 0.0 is +0.0."""
    return re.sub(r"\bround\(", "CAST(0 AS DOUBLE) + round(", sql)


ORACLE_SQL: dict[str, str] = {
    "label_histogram": LABEL_HISTOGRAM,
    "parse_numeric": PARSE_NUMERIC,
    "category_dictionary": CATEGORY_DICTIONARY,
    "one_hot_features": ONE_HOT_FEATURES,
    "one_hot_sparse": ONE_HOT_SPARSE,
    "sparse_assign": APPLY_SAVED_MODEL,
    "column_stats": COLUMN_STATS,
    "zscore": ZSCORE,
    "standard_scale": STANDARD_SCALE,
    "assign_clusters": ASSIGN_CLUSTERS,
    "distance_to_centroid": DISTANCE_TO_CENTROID,
    "clustering_score": CLUSTERING_SCORE,
    "cluster_label_counts": CLUSTER_LABEL_COUNTS,
    "weighted_entropy": WEIGHTED_ENTROPY,
    "lloyd_3": LLOYD_3,
    "sweep_k": SWEEP_K,
    "sweep_k_entropy": SWEEP_K_ENTROPY,
    "kmeans_many_runs": KMEANS_MANY_RUNS,
    "sweep_records_raw": SWEEP_RECORDS_RAW,
    "sweep_records_z": SWEEP_RECORDS_Z,
    "sweep_records_one_hot": SWEEP_RECORDS_ONE_HOT,
    "sweep_records_entropy": SWEEP_RECORDS_ENTROPY,
    "kth_largest": KTH_LARGEST,
    "precision_by_threshold": PRECISION_BY_THRESHOLD,
    "random_projection": RANDOM_PROJECTION,
    "detect_anomalies": DETECT_ANOMALIES,
    "detect_lines": DETECT_ANOMALIES,
    "anomalies_kmeans": ANOMALIES_KMEANS,
    "kmeans_fit": KMEANS_FIT,
    "build_model": BUILD_MODEL,
    "apply_saved_model": APPLY_SAVED_MODEL,
    "profile_clusters": PROFILE_CLUSTERS,
    "sample_assignments": SAMPLE_ASSIGNMENTS,
    "online_update": ONLINE_UPDATE,
    "online_update_points": ONLINE_UPDATE_POINTS,
    "online_score": ONLINE_SCORE,
    "stream_kmeans": STREAM_KMEANS,
    "stream_centers": STREAM_CENTERS,
    "stream_cluster_label_counts": STREAM_CLUSTER_LABEL_COUNTS,
    "stream_mean_distance": STREAM_MEAN_DISTANCE,
    "stream_predict": STREAM_PREDICT,
    "parse_vectors": PARSE_VECTORS,
    "column_moments": COLUMN_MOMENTS,
    "merged_stats": COLUMN_STATS,
    "random_projection_seeded": RANDOM_PROJECTION_SEEDED,
    "cluster_count": CLUSTER_COUNT,
    "top_anomalies": TOP_ANOMALIES_SQL,
    "online_crosstab": ONLINE_CROSSTAB,
    "online_random_start": ONLINE_RANDOM_START,
    "sample_fitted": SAMPLE_FITTED,
    "stream_idle_ticks": STREAM_IDLE_TICKS,
    "stream_write_assignments": STREAM_WRITE_ASSIGNMENTS,
    "stream_new_files": STREAM_NEW_FILES,
    "stream_saved_model": STREAM_SAVED_MODEL,
    "stream_word_count": STREAM_WORD_COUNT,
}
ORACLE_SQL = {name: _positive_zero(sql) for name, sql in ORACLE_SQL.items()}
