"""The same results as plain SQL on the same tables, for the correctness check.

The SQL states each definition directly (sorted lists, row numbers, full outer
grids); none of it mirrors how the Spark jobs are built.
"""

from __future__ import annotations

import math

from tidegauge.functions.stats import (
    HASH_KEY_STEP,
    HASH_MODULUS,
    HASH_REP_STEP,
    HASH_ROUND,
    KS_TERMS,
)
from tidegauge.operators.metrics import GRID_FIRST, GRID_LAST, GRID_SIZE
from tidegauge.operators.policy import GUARD_LABELS
from tidegauge.plans.catalog import DATES, EVENTS, GUARDS, REPETITIONS, WIDE
from tidegauge.types import ACTION_NAMES


def chi2_quantile(p: float, dof: int) -> float:
    """Chi-squared quantile from the closed form of the upper tail, which is a finite sum.

    Stated apart from the engine's own function, so that an error there shows.
    """

    def tail(x: float) -> float:
        h = x / 2
        if dof % 2 == 0:
            return math.exp(-h) * sum(h**i / math.factorial(i) for i in range(dof // 2))
        return math.erfc(math.sqrt(h)) + math.exp(-h) * sum(h ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (dof + 1) // 2))

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > 1 - p else (low, middle)
    return low


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name}"


def split_hash(key: str, rep: str, seed: int = 0) -> str:
    m = HASH_MODULUS
    h1 = f"((CAST({key} AS BIGINT) % {m}) * {HASH_KEY_STEP} + (CAST({rep} AS BIGINT) + {seed + 1}) * {HASH_REP_STEP}) % {m}"
    h2 = f"(({h1}) * ({h1}) + (CAST({rep} AS BIGINT) + {seed}) * {HASH_ROUND} + 1) % {m}"
    return f"((({h2}) * ({h2}) + {HASH_ROUND}) % {m})"


EV = """ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k,
  date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS day, user_id % 4 AS seg FROM events)"""
REF = "ref AS (SELECT * FROM ev WHERE day <= 15)"
CUR = "cur AS (SELECT * FROM ev WHERE day > 15)"
U0, U1 = (f"({split_hash('event_id', s)} / {HASH_MODULUS}.0)" for s in ("0", "1"))
PLANTED = f"""sh AS (SELECT * REPLACE (CASE WHEN day BETWEEN 19 AND 21 AND {U1} < 0.6 THEN 'view' ELSE event_type END AS event_type) FROM ev),
so AS (SELECT *, CASE WHEN seg = 2 AND day BETWEEN 22 AND 25 THEN value + 3.5 * (0.75 + 0.25 * {U0}) ELSE value END AS real_value FROM sh),
sv AS (SELECT * REPLACE (CASE WHEN seg = 2 AND day BETWEEN 22 AND 25 THEN real_value - 3.5 ELSE real_value END AS value) FROM so),
pl AS (SELECT * REPLACE (CASE WHEN day >= 28 THEN value * 6.894757 ELSE value END AS value) FROM sv)"""


def scored(src: str, name: str) -> str:
    return f"""{name} AS (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
  ((event_id * 7919) % 1000) / 1000.0 * 0.6 + CASE WHEN event_type = 'error' AND NOT (seg = 2 AND day BETWEEN 22 AND 25) THEN 0.25 ELSE 0.05 END AS p FROM {src})"""


def windows(src: str, name: str, first: int = 18, last: int = 30) -> str:
    return f"""{name} AS (SELECT w AS "window", x.* FROM {src} x JOIN range({first}, {last + 1}) t(w) ON x.day > w - 3 AND x.day <= w)"""


def long_num(src: str, name: str, by: str = "") -> str:
    b = by + ", " if by else ""
    return (
        f"{name} AS (SELECT {b}'value' AS feature, value AS v FROM {src} WHERE value IS NOT NULL "
        f"UNION ALL SELECT {b}'k', k FROM {src} WHERE k IS NOT NULL)"
    )


def edges(src: str, by: str, name: str, bins: int = 10, value: str = "v") -> str:
    """Sorted distinct linear quantiles of each group."""
    lo, hi = "l[CAST(floor(p) AS BIGINT) + 1]", "l[CAST(ceil(p) AS BIGINT) + 1]"
    return f"""{name}_s AS (SELECT {by}, list_sort(list({value})) AS l FROM {src} GROUP BY {by}),
{name}_p AS (SELECT {by}, l, least(i * {dbl(1.0 / bins)}, 1.0) * (len(l) - 1) AS p FROM {name}_s, range({bins + 1}) t(i)),
{name} AS (SELECT {by}, list_sort(list_distinct(list(CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} + ({hi} - {lo}) * (p - floor(p)) END))) AS e
  FROM {name}_p GROUP BY {by})"""


BIN = "len(list_filter(e[2:len(e) - 1], lambda t: t <= v))"


def psi_shared(ref: str, cur: str, by: str, name: str = "psi") -> str:
    """PSI of every group of ``cur`` against the one reference."""
    return f"""{edges(ref, "feature", name + "_e")},
{name}_r AS (SELECT feature, {BIN} AS bin, count(*) AS n FROM {ref} JOIN {name}_e USING (feature) GROUP BY ALL),
{name}_c AS (SELECT {by}, feature, {BIN} AS bin, count(*) AS n FROM {cur} JOIN {name}_e USING (feature) GROUP BY ALL),
{name}_g AS (SELECT {by}, feature, sum(n) AS m FROM {name}_c GROUP BY ALL),
{name}_b AS (SELECT feature, unnest(range(len(e) - 1)) AS bin FROM {name}_e),
{name}_t AS (SELECT feature, sum(n) AS n FROM {name}_r GROUP BY ALL),
{name} AS (SELECT {", ".join("g." + b.strip() for b in by.split(","))}, g.feature, CAST(max(g.m) AS BIGINT) AS m,
  sum((greatest(coalesce(c.n, 0) / g.m, 1e-6) - greatest(coalesce(r.n, 0) / t.n, 1e-6))
    * ln(greatest(coalesce(c.n, 0) / g.m, 1e-6) / greatest(coalesce(r.n, 0) / t.n, 1e-6))) AS psi
  FROM {name}_g g JOIN {name}_b b ON g.feature = b.feature JOIN {name}_t t ON g.feature = t.feature
  LEFT JOIN {name}_r r ON r.feature = b.feature AND r.bin = b.bin
  LEFT JOIN {name}_c c ON c.feature = b.feature AND c.bin = b.bin AND {" AND ".join(f"c.{b.strip()} = g.{b.strip()}" for b in by.split(","))}
  GROUP BY ALL)"""


def cdf_shared(ref: str, cur: str, by: str, name: str = "cdf") -> str:
    """Both distribution functions on the union grid of each group."""
    g = ", ".join("g." + b.strip() for b in by.split(","))
    return f"""{name}_g AS (SELECT {by}, feature, count(*) AS m FROM {cur} GROUP BY ALL),
{name}_n AS (SELECT feature, count(*) AS n FROM {ref} GROUP BY ALL),
{name}_u AS (SELECT {g}, g.feature, r.v, 1 AS a, 0 AS b FROM {name}_g g JOIN {ref} r ON r.feature = g.feature
  UNION ALL SELECT {by}, feature, v, 0, 1 FROM {cur}),
{name}_v AS (SELECT {by}, feature, v, sum(a) AS a, sum(b) AS b FROM {name}_u GROUP BY ALL),
{name} AS (SELECT u.*, n.n, g.m, sum(a) OVER o / n.n AS fa, sum(b) OVER o / g.m AS fb, lead(v) OVER o AS nxt
  FROM {name}_v u JOIN {name}_n n USING (feature) JOIN {name}_g g USING ({by}, feature)
  WINDOW o AS (PARTITION BY {", ".join("u." + b.strip() for b in by.split(","))}, u.feature ORDER BY v))"""


def ks_p(d: str, n: str, m: str) -> str:
    root = f"sqrt({n}::DOUBLE * {m} / ({n}::DOUBLE + {m}))"
    lam = f"({d} * ({root} + 0.12 + 0.11 / {root}))"
    return (
        f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE greatest(least(list_sum(list_transform(range(1, {KS_TERMS + 1}), "
        f"lambda j: (CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * j * j * {lam} * {lam}))), 1.0), 0.0) END"
    )


def cat_stats(ref: str, cur: str, by: str, column: str, name: str = "cat") -> str:
    """Jensen-Shannon and chi-squared of one categorical column over the full category grid."""
    g = ", ".join("g." + b.strip() for b in by.split(","))
    on = " AND ".join(f"c.{b.strip()} = g.{b.strip()}" for b in by.split(","))
    return f"""{name}_r AS (SELECT {column} AS c, count(*) AS n FROM {ref} WHERE {column} IS NOT NULL GROUP BY ALL),
{name}_c AS (SELECT {by}, {column} AS c, count(*) AS n FROM {cur} WHERE {column} IS NOT NULL GROUP BY ALL),
{name}_g AS (SELECT {by}, sum(n)::DOUBLE AS m FROM {name}_c GROUP BY ALL),
{name}_k AS (SELECT {g}, k.c, g.m FROM {name}_g g, (SELECT c FROM {name}_r) k
  UNION SELECT {g}, c.c, g.m FROM {name}_g g JOIN {name}_c c ON {on}),
{name}_x AS (SELECT {g}, coalesce(r.n, 0)::DOUBLE AS o1, coalesce(c.n, 0)::DOUBLE AS o2, (SELECT sum(n) FROM {name}_r)::DOUBLE AS n1, g.m AS n2
  FROM {name}_k g LEFT JOIN {name}_r r ON r.c = g.c LEFT JOIN {name}_c c ON c.c = g.c AND {on}),
{name}_y AS (SELECT *, o1 / n1 AS p, o2 / n2 AS q, (o1 + o2) * n1 / (n1 + n2) AS e1, (o1 + o2) * n2 / (n1 + n2) AS e2 FROM {name}_x),
{name} AS (SELECT {by}, count(*) AS c, CAST(max(n2) AS BIGINT) AS m,
  least(greatest(sum(CASE WHEN p > 0 THEN 0.5 * p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(q / ((p + q) / 2)) ELSE 0 END), 0), 1) AS js,
  CASE WHEN count(*) < 2 THEN NULL WHEN count(*) = 2
    THEN sum(power(abs(o1 - e1) - least(0.5, abs(o1 - e1)), 2) / e1 + power(abs(o2 - e2) - least(0.5, abs(o2 - e2)), 2) / e2)
    ELSE sum(power(o1 - e1, 2) / e1 + power(o2 - e2, 2) / e2) END AS chi2
  FROM {name}_y GROUP BY ALL)"""


def paired_psi(src: str, by: str, name: str = "pp") -> str:
    """PSI of side 1 against side 0 within each group of ``src`` (by..., side, v)."""
    return f"""{name}_0 AS (SELECT * FROM {src} WHERE side = 0),
{edges(name + "_0", by, name + "_e")},
{name}_b AS (SELECT {by}, {BIN} AS bin, count(*) FILTER (side = 0) AS n0, count(*) FILTER (side = 1) AS n1
  FROM {src} JOIN {name}_e USING ({by}) GROUP BY ALL),
{name}_n AS (SELECT {by}, sum(n0) AS t0, sum(n1) AS t1 FROM {name}_b GROUP BY ALL),
{name} AS (SELECT {by}, CAST(max(t0) AS BIGINT) AS n0, CAST(max(t1) AS BIGINT) AS n1,
  sum((greatest(n1 / t1, 1e-6) - greatest(n0 / t0, 1e-6)) * ln(greatest(n1 / t1, 1e-6) / greatest(n0 / t0, 1e-6))) AS psi
  FROM {name}_b JOIN {name}_n USING ({by}) GROUP BY ALL)"""


def paired_js(src: str, by: str, column: str, name: str = "pj") -> str:
    return f"""{name}_c AS (SELECT {by}, {column} AS c, count(*) FILTER (side = 0) AS o0, count(*) FILTER (side = 1) AS o1 FROM {src} GROUP BY ALL),
{name}_p AS (SELECT *, o0 / sum(o0) OVER g AS p, o1 / sum(o1) OVER g AS q, sum(o0) OVER g AS t0, sum(o1) OVER g AS t1 FROM {name}_c WINDOW g AS (PARTITION BY {by})),
{name} AS (SELECT {by}, CAST(max(t0) AS BIGINT) AS n0, CAST(max(t1) AS BIGINT) AS n1,
  sum(CASE WHEN p > 0 THEN 0.5 * p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(q / ((p + q) / 2)) ELSE 0 END) AS js FROM {name}_p GROUP BY ALL)"""


def reps(src: str, name: str, seed: int = 0) -> str:
    return f"""{name} AS (SELECT rep, CASE WHEN {split_hash('event_id', 'rep', seed)} < {int(HASH_MODULUS * 0.5)} THEN 0 ELSE 1 END AS side, x.*
  FROM {src} x, range({REPETITIONS}) t(rep))"""


def blocks(src: str, name: str, n: int) -> str:
    """Consecutive blocks and the two roles a row plays."""
    return f"""{name}_o AS (SELECT *, row_number() OVER (ORDER BY day, event_id) - 1 AS rn, count(*) OVER () AS total FROM {src}),
{name}_b AS (SELECT *, rn // (total // {n}) AS block FROM {name}_o WHERE rn // (total // {n}) < {n}),
{name} AS (SELECT block AS pair, 0 AS side, * FROM {name}_b WHERE block < {n - 1}
  UNION ALL SELECT block - 1 AS pair, 1 AS side, * FROM {name}_b WHERE block > 0)"""


def effects(src: str, key: str, name: str = "eff") -> str:
    """All features' effects of the paired groups of ``src``."""
    return f"""{long_num(src, name + "_l", key + ", side")},
{paired_psi(name + "_l", key + ", feature", name + "_n")},
{paired_js(src, key, "event_type", name + "_j")},
{name} AS (SELECT {key}, feature, 'num' AS kind, n0, n1, psi AS effect FROM {name}_n
  UNION ALL SELECT {key}, 'event_type', 'cat', n0, n1, js * 2.5 FROM {name}_j)"""


def score_groups(src: str, by: str, name: str = "sg") -> str:
    """Ranking metrics of each group."""
    return f"""{name}_c AS (SELECT {by}, p AS s, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY ALL),
{name}_r AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, sum(pos) OVER g AS np, sum(neg) OVER g AS nn
  FROM {name}_c WINDOW o AS (PARTITION BY {by} ORDER BY s DESC), g AS (PARTITION BY {by})),
{name} AS (SELECT {by}, CAST(max(np + nn) AS BIGINT) AS n, CAST(max(np) AS BIGINT) AS n_pos,
  sum(neg * (tp - pos / 2.0)) / (max(np) * max(nn)) AS auc, sum(pos / np * (tp / (tp + fp))) AS ap,
  -sum(pos * ln(least(greatest(s, 1e-7), 1 - 1e-7)) + neg * ln(1 - least(greatest(s, 1e-7), 1 - 1e-7))) / max(np + nn) AS loss
  FROM {name}_r GROUP BY ALL)"""


def mcc_expr(tp: str, fp: str, fn: str, tn: str) -> str:
    d = f"(({tp} + {fp})::DOUBLE * ({tp} + {fn}) * ({tn} + {fp}) * ({tn} + {fn}))"
    return f"CASE WHEN {d} = 0 THEN 0.0 ELSE ({tp}::DOUBLE * {tn} - {fp}::DOUBLE * {fn}) / sqrt({d}) END"


def best_mcc(src: str, by: str, name: str = "bm") -> str:
    step = (GRID_LAST - GRID_FIRST) / (GRID_SIZE - 1)
    lo, hi = "l[CAST(floor(q) AS BIGINT) + 1]", "l[CAST(ceil(q) AS BIGINT) + 1]"
    keys = " AND ".join(f"c.{b.strip()} = t.{b.strip()}" for b in by.split(","))
    tby = ", ".join("t." + b.strip() for b in by.split(","))
    return f"""{name}_l AS (SELECT {by}, list_sort(list(p)) AS l FROM {src} GROUP BY ALL),
{name}_q AS (SELECT {by}, l, ({dbl(GRID_FIRST)} + i * {dbl(step)}) * (len(l) - 1) AS q FROM {name}_l, range({GRID_SIZE}) g(i)),
{name}_t AS (SELECT DISTINCT {by}, CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} + ({hi} - {lo}) * (q - floor(q)) END AS th FROM {name}_q),
{name}_s AS (SELECT {by}, p AS s, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY ALL),
{name}_c AS (SELECT {tby}, t.th, coalesce(sum(pos) FILTER (s >= th), 0) AS tp, coalesce(sum(neg) FILTER (s >= th), 0) AS fp, sum(pos) AS np, sum(neg) AS nn
  FROM {name}_t t JOIN {name}_s c ON {keys} GROUP BY ALL),
{name}_m AS (SELECT {by}, th, {mcc_expr("tp", "fp", "(np - tp)", "(nn - fp)")} AS m FROM {name}_c),
{name} AS (SELECT {by}, th, m FROM {name}_m QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY m DESC, th) = 1)"""


def mcc_at(src: str, by: str, t: str, name: str = "ma") -> str:
    return f"""{name}_c AS (SELECT {by}, sum(y) FILTER (p >= {t}) AS tp0, sum(1 - y) FILTER (p >= {t}) AS fp0, sum(y) AS np, sum(1 - y) AS nn FROM {src} GROUP BY ALL),
{name}_d AS (SELECT *, coalesce(tp0, 0) AS tp, coalesce(fp0, 0) AS fp FROM {name}_c),
{name} AS (SELECT {by}, {mcc_expr("tp", "fp", "(np - tp)", "(nn - fp)")} AS m FROM {name}_d)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


Q1 = chi2_quantile(0.95, 9)
Q2 = chi2_quantile(0.95 ** (1 / 2), 9)
Q6 = chi2_quantile(0.95 ** (1 / 6), 9)
ALPHA = 0.05 / 3
ORACLES: dict[str, str] = {}

# --- sources, projections ----------------------------------------------------
ORACLES["pruned_scan"] = f"""SELECT l_returnflag, count(*) AS n, {r("sum(l_quantity)", "quantity")} FROM lineitem
WHERE l_quantity > 40 AND l_discount < 0.03 GROUP BY l_returnflag"""
ORACLES["last_decision_per_monitor"] = f"""SELECT user_id, event_id, event_type, {r("value", "value")} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
ORACLES["coerced_numbers"] = """WITH x AS (SELECT event_type, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'n/a' WHEN event_id % 10 = 1 THEN 'Infinity'
  ELSE regexp_extract(props, '([0-9]+)', 1) END AS DOUBLE) AS v FROM events)
SELECT event_type, count(v) AS n_number, count(v) FILTER (isfinite(v)) AS n_finite, sum(v) FILTER (isfinite(v)) AS total FROM x GROUP BY event_type"""


def violations(src: str) -> str:
    return (
        f"{windows(src, 'cw')}, {long_num('cw', 'lw', '\"window\"')}, vi AS (SELECT \"window\", feature, count(*) AS n, "
        "avg(CASE WHEN v < 0 OR v > CASE feature WHEN 'value' THEN 200 ELSE 94 END THEN 1.0 ELSE 0.0 END) AS fraction FROM lw GROUP BY ALL)"
    )


ORACLES["range_violation"] = with_(EV, violations("ev")) + f'SELECT "window", feature, n, {r("fraction", "fraction")} FROM vi'
ORACLES["worst_range_feature"] = with_(EV, PLANTED, violations("pl")) + f"""SELECT "window", feature AS worst_feature, {r("fraction", "worst_fraction")}
FROM vi WHERE fraction > 0.10 QUALIFY row_number() OVER (PARTITION BY "window" ORDER BY fraction DESC, feature) = 1"""
ORACLES["absolute_deviation"] = f"""SELECT event_type, {r("avg(abs(value - 50))", "mean_dev")}, {r("max(abs(value - 50))", "max_dev")} FROM events GROUP BY event_type"""

WIDE_CTE = "wide AS (SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in WIDE.items()) + " FROM lineitem)"
PROF = "prof AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, count({n}) AS n_valid, count({n}) / count(*) AS coverage, "
    f"CASE WHEN count({n}) > 100 THEN var_pop({n}) ELSE 0 END AS variance FROM wide" for n in WIDE
) + ")"
TOPO = r"""topo AS (SELECT feature, regexp_extract(feature, '^L(\d+)_S(\d+)_[FD](\d+)$', ['a', 'b', 'c']) AS g FROM prof
  WHERE regexp_matches(feature, '^L(\d+)_S(\d+)_[FD](\d+)$'))"""
ORACLES["column_topology"] = with_(WIDE_CTE, PROF, TOPO) + """SELECT feature, CAST(g.a AS BIGINT) AS line, CAST(g.b AS BIGINT) AS station_no,
CAST(g.c AS BIGINT) AS number, 'L' || g.a || '_S' || g.b AS station, n_valid FROM prof LEFT JOIN topo USING (feature)"""
ORACLES["coverage_threshold"] = with_(WIDE_CTE, PROF) + f"""SELECT feature, {r("coverage", "coverage")}, {r("0.01 / sqrt(greatest(coverage, 0.01))", "threshold")} FROM prof"""
ORACLES["feature_profile"] = with_(WIDE_CTE, PROF) + f"""SELECT feature, n_valid, {r("coverage", "coverage")}, {r("variance", "variance", 4)} FROM prof"""
ORACLES["feature_selection"] = with_(WIDE_CTE, PROF, TOPO) + """,
el AS (SELECT feature, coverage, variance, CASE WHEN g IS NOT NULL THEN 'L' || g.a || '_S' || g.b END AS station FROM prof LEFT JOIN topo USING (feature)
  WHERE coverage >= 0.05 AND variance > 1e-12),
q AS (SELECT *, station IS NOT NULL AND row_number() OVER (PARTITION BY station ORDER BY coverage DESC, variance DESC, feature) <= 1 AS quota FROM el)
SELECT feature, station, quota FROM q QUALIFY row_number() OVER (ORDER BY quota DESC, coverage DESC, variance DESC, feature) <= 5""".replace("\n,\nel", ",\nel", 1)
ORACLES["selected_columns"] = f"""SELECT count(*) AS n, {r("sum(l_quantity)", "quantity", 2)} FROM lineitem"""

DATE_CTE = "d0 AS (SELECT o_orderkey AS Id, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 14.25 AS t FROM orders),\ndates AS (SELECT Id, " + ", ".join(
    f"CASE WHEN {ok} THEN CAST(t + {off} AS FLOAT) END AS {n}" for n, (off, ok) in DATES.items()
) + " FROM d0)"
COLS = ", ".join(DATES)
META = f"""m0 AS (SELECT Id, least({COLS}) AS t_min, greatest({COLS}) AS t_max,
  CASE WHEN coalesce(L0_S0_D1, L0_S0_D2) IS NOT NULL THEN 1 ELSE 0 END AS vis_L0_S0, CASE WHEN L0_S1_D4 IS NOT NULL THEN 1 ELSE 0 END AS vis_L0_S1,
  CASE WHEN L1_S24_D6 IS NOT NULL THEN 1 ELSE 0 END AS vis_L1_S24, CASE WHEN L1_S25_D8 IS NOT NULL THEN 1 ELSE 0 END AS vis_L1_S25,
  CASE WHEN L2_S30_D10 IS NOT NULL THEN 1 ELSE 0 END AS vis_L2_S30 FROM dates),
meta AS (SELECT *, vis_L0_S0 + vis_L0_S1 + vis_L1_S24 + vis_L1_S25 + vis_L2_S30 AS n_stations, t_max - t_min AS duration,
  CAST(coalesce(floor(t_min * CAST(0.01 AS FLOAT)), -1) AS BIGINT) AS week, CASE WHEN Id % 171 = 7 THEN 1 ELSE 0 END AS Response FROM m0)"""
ORACLES["row_first_last"] = with_(DATE_CTE) + f"""SELECT Id % 30 AS g, count(least({COLS})) AS n_dated, {r(f"min(least({COLS})::DOUBLE)", "first")},
{r(f"max(greatest({COLS})::DOUBLE)", "last")}, {r(f"sum(greatest({COLS})::DOUBLE - least({COLS})::DOUBLE)", "crossing", 4)} FROM dates GROUP BY 1"""
ORACLES["station_presence"] = with_(DATE_CTE, META) + """SELECT CAST(n_stations AS BIGINT) AS n_stations, count(*) AS parts, CAST(sum(vis_L0_S0) AS BIGINT) AS l0_s0,
CAST(sum(vis_L0_S1) AS BIGINT) AS l0_s1, CAST(sum(vis_L1_S24) AS BIGINT) AS l1_s24, CAST(sum(vis_L1_S25) AS BIGINT) AS l1_s25,
CAST(sum(vis_L2_S30) AS BIGINT) AS l2_s30 FROM meta GROUP BY 1"""
ORACLES["time_bucket"] = with_(DATE_CTE, META) + "SELECT week, CAST(floor(week / 2) AS BIGINT) AS fortnight, count(*) AS n FROM meta GROUP BY ALL"
ORACLES["time_axis"] = with_(DATE_CTE, META) + f"""SELECT Id, {r("t_min::DOUBLE", "t_min")}, {r("t_max::DOUBLE", "t_max")}, CAST(n_stations AS BIGINT) AS n_stations,
{r("duration::DOUBLE", "duration")}, week, CAST(floor(week / 2) AS BIGINT) AS fortnight, CAST(Response AS BIGINT) AS Response FROM meta"""
ORACLES["metadata_round_trip"] = with_(DATE_CTE, META) + f"""SELECT week, count(*) AS n, CAST(sum(n_stations) AS BIGINT) AS stations, {r("max(t_max)::DOUBLE", "latest")} FROM meta GROUP BY week"""
ORACLES["features_round_trip"] = f"""SELECT o_orderstatus AS status, count(*) AS n, {r("sum(o_totalprice)", "price", 2)} FROM orders WHERE o_totalprice > 100000 GROUP BY 1"""
ORACLES["wide_csv_round_trip"] = with_(DATE_CTE) + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS n, {r(f"sum({c}::DOUBLE)", "total", 2)} FROM dates""" for c in DATES
)
ORACLES["results_round_trip"] = with_(EV) + """SELECT f AS format, CAST(day AS BIGINT) AS day, count(*) AS n FROM ev, (VALUES ('csv'), ('json')) t(f) GROUP BY ALL"""
ORACLES["contract_round_trip"] = with_(EV, REF) + f"""SELECT f.feature, {r(f"{dbl(Q2)} * (1.0 / (count(*) // 2) + 1.0 / (count(*) - count(*) // 2))", "floor", 9)},
{r(f"3 * {dbl(Q2)} * (1.0 / (count(*) // 2) + 1.0 / (count(*) - count(*) // 2))", "threshold", 9)}, CAST(10 AS BIGINT) AS bins, CAST(3 AS BIGINT) AS k, CAST(5 AS BIGINT) AS n FROM ref, (VALUES ('value'), ('k')) f(feature) GROUP BY 1"""
ORACLES["undated_last"] = with_(DATE_CTE, META, "pl AS (SELECT row_number() OVER (ORDER BY t_min NULLS LAST, Id) AS place, Id, t_min FROM meta)") + f"""SELECT place, Id, {r("t_min::DOUBLE", "t_min")} FROM pl WHERE t_min IS NULL"""
ORACLES["time_order_places"] = with_(DATE_CTE, META) + f"""SELECT row_number() OVER (ORDER BY t_min NULLS LAST, Id) AS place, Id, {r("t_min::DOUBLE", "t_min")} FROM meta"""
ORACLES["weekly_rates"] = with_(DATE_CTE, META) + f"""SELECT week, count(*) AS n, {r("avg(Response)", "rate")}, {r("avg(n_stations)", "mean_stations")} FROM meta GROUP BY week"""
ORACLES["presence_spread"] = with_(DATE_CTE, META) + ",\nsh AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS station, week, avg({c}) AS s FROM meta WHERE week >= 0 GROUP BY week"
    for c in ("vis_L0_S0", "vis_L0_S1", "vis_L1_S24", "vis_L1_S25", "vis_L2_S30")
) + f""")
SELECT station, {r("min(s)", "lowest")}, {r("max(s)", "highest")}, {r("max(s) - min(s)", "spread")} FROM sh GROUP BY station"""
ORACLES["artefact_checks"] = with_(DATE_CTE, META) + f""",
wk AS (SELECT week, avg(Response) AS r FROM meta GROUP BY week),
ft AS (SELECT o_orderkey AS Id FROM orders),
o AS (SELECT 'unique key in meta' AS "check", (SELECT count(*) FROM (SELECT Id FROM meta GROUP BY Id HAVING count(*) > 1))::DOUBLE AS observed, 0.0 AS lo, 0.0 AS hi, false AS strict
 UNION ALL SELECT 'unique key in features', (SELECT count(*) FROM (SELECT Id FROM ft GROUP BY Id HAVING count(*) > 1)), 0, 0, false
 UNION ALL SELECT 'same keys', (SELECT count(*) FROM meta FULL JOIN ft ON meta.Id = ft.Id WHERE meta.Id IS NULL OR ft.Id IS NULL), 0, 0, false
 UNION ALL SELECT 'labels present', (SELECT count(*) FROM meta WHERE Response IS NULL), 0, 0, false
 UNION ALL SELECT 'failure rate in range', (SELECT avg(Response) FROM meta), 0.004, 0.008, true
 UNION ALL SELECT 'enough weeks', (SELECT count(DISTINCT week) FROM meta), 15, 1e9, false
 UNION ALL SELECT 'presence columns', 5, 5, 1e9, false
 UNION ALL SELECT 'time order', (SELECT count(*) FROM (SELECT t_min < lag(t_min) OVER (ORDER BY Id) AS falls FROM meta WHERE t_min IS NOT NULL) WHERE falls), 0, 0, false
 UNION ALL SELECT 'failures spread over time', (SELECT stddev_samp(r) / avg(r) FROM wk), -1, 2, true)
SELECT "check", CASE WHEN strict THEN observed > lo AND observed < hi ELSE observed >= lo AND observed <= hi END AS ok, {r("observed", "observed")} FROM o""".lstrip()

ORACLES["sliding_windows"] = with_(EV, windows("ev", "cw")) + f"""SELECT "window", count(*) AS n, {r("sum(value)", "v", 4)} FROM cw GROUP BY 1"""
ORACLES["segment_windows"] = with_(EV, windows("ev", "cw")) + 'SELECT "window", seg, count(*) AS n FROM cw GROUP BY ALL'
EVENT_CASE = "CASE " + " ".join(f"WHEN day BETWEEN {e['start']} AND {e['end']} THEN '{e['name']}'" for e in EVENTS) + " END"
ORACLES["event_label"] = with_(EV) + f"SELECT CAST(day AS BIGINT) AS day, count(*) AS n, {EVENT_CASE} AS event FROM ev GROUP BY day"
CONTEXT_CASE = "CASE " + " ".join(f"WHEN day BETWEEN {a} AND {b} THEN '{n}'" for n, (a, b) in GUARDS.contexts.items()) + " END"
ORACLES["context_label"] = with_(EV) + f"SELECT CAST(day AS BIGINT) AS day, count(*) AS n, {CONTEXT_CASE} AS context FROM ev GROUP BY day"
ORACLES["alarm_predicate"] = """WITH x AS (SELECT user_id, avg(CASE event_type WHEN 'error' THEN 0.0 WHEN 'view' THEN 0.01 END) AS p, avg(value) / 100 AS e FROM events GROUP BY user_id)
SELECT user_id, coalesce(p < 0.0051 AND e > 0.5, false) AS alarm FROM x"""

# --- joins -----------------------------------------------------------------
ORACLES["joined_one_to_one"] = """SELECT d.doc_id, lang, CAST(n_chars AS BIGINT) AS n_chars, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
ORACLES["inner_one_to_one"] = with_(DATE_CTE, META) + f"""SELECT week, count(*) AS n, {r("sum(o_totalprice)", "price", 2)} FROM meta JOIN orders ON Id = o_orderkey GROUP BY week"""
ORACLES["suffixed_tables"] = with_(EV) + """SELECT event_type, count(*) FILTER (day <= 15) AS n_ref, count(*) FILTER (day > 15) AS n_cur FROM ev GROUP BY event_type"""
ORACLES["category_alignment"] = with_(EV, PLANTED) + """SELECT event_type AS category, count(*) FILTER (day <= 15) AS n_ref, count(*) FILTER (day > 15) AS n_cur
FROM pl GROUP BY 1"""
ORACLES["membership"] = with_(EV) + """, dc AS (SELECT day, count(*) AS n FROM ev GROUP BY day),
kept AS (SELECT day FROM dc WHERE n > 0.4 * (SELECT median(n) FROM dc) ORDER BY day LIMIT 4)
SELECT 'in' AS part, count(*) AS n FROM ev WHERE day IN (SELECT day FROM kept) UNION ALL SELECT 'out', count(*) FROM ev WHERE day NOT IN (SELECT day FROM kept)""".lstrip()
ORACLES["key_set_diff"] = """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left' ELSE 'right' END AS side
FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL"""

# --- two-sample measurement --------------------------------------------------
LR = long_num("ref", "lr")
W = '"window"'
ORACLES["reference_edges"] = with_(EV, REF, LR, edges("lr", "feature", "ed")) + f""",
x AS (SELECT feature, unnest(range(len(e))) AS i, unnest(e) AS edge FROM ed) SELECT feature, CAST(i AS BIGINT) AS i, {r("edge", "edge")} FROM x""".lstrip()
ORACLES["bin_histogram"] = with_(EV, REF, LR, edges("lr", "feature", "ed"), windows("ev", "cw"), long_num("cw", "lw", W)) + (
    f"SELECT {W}, feature, CAST({BIN} AS BIGINT) AS bin, count(*) AS n FROM lw JOIN ed USING (feature) GROUP BY ALL"
)
ORACLES["psi"] = with_(EV, REF, CUR, LR, "c1 AS (SELECT 0 AS g, * FROM cur)", long_num("c1", "lc", "g"), psi_shared("lr", "lc", "g")) + (
    f"SELECT feature, m AS n_cur_finite, {r('psi', 'psi')} FROM psi"
)
ORACLES["js_divergence"] = with_(EV, REF, PLANTED, windows("pl", "cw"), cat_stats("ref", "cw", W, "event_type")) + (
    f"SELECT {W}, 'event_type' AS feature, {r('js', 'js')} FROM cat"
)
CDF_EV = (EV, REF, LR, windows("ev", "cw"), long_num("cw", "lw", W), cdf_shared("lr", "lw", W))
ORACLES["wasserstein"] = with_(*CDF_EV) + f"SELECT {W}, feature, {r('sum(abs(fa - fb) * (nxt - v))', 'wasserstein', 5)} FROM cdf GROUP BY ALL"
ORACLES["ks_statistic"] = with_(*CDF_EV) + f"SELECT {W}, feature, {r('max(abs(fa - fb))', 'ks')} FROM cdf GROUP BY ALL"
SW = f"seg, {W}"
ORACLES["ks_pvalue"] = with_(EV, REF, PLANTED, LR, windows("pl", "cw"), long_num("cw", "lw", SW), cdf_shared("lr", "lw", SW),
    f"d AS (SELECT {SW}, feature, max(abs(fa - fb)) AS d, max(n) AS n, max(m) AS m FROM cdf GROUP BY ALL)") + (
    f"SELECT {SW}, feature, {r(ks_p('d', 'n', 'm'), 'p_value')} FROM d"
)
ORACLES["chi2_statistic"] = with_(EV, REF, PLANTED, windows("pl", "cw"), cat_stats("ref", "cw", W, "event_type")) + (
    f"SELECT {W}, 'event_type' AS feature, {r('chi2', 'chi2', 4)}, CAST(c - 1 AS BIGINT) AS dof FROM cat"
)
ORACLES["chi2_two_categories"] = with_(EV, "fl AS (SELECT *, event_type = 'error' AS is_error FROM ev)", "ref AS (SELECT * FROM fl WHERE day <= 15)",
    windows("fl", "cw"), cat_stats("ref", "cw", W, "is_error")) + f"SELECT {W}, {r('chi2', 'chi2', 5)}, CAST(c - 1 AS BIGINT) AS dof FROM cat"
ORACLES["chi2_pvalue"] = with_(EV, REF, windows("ev", "cw"), cat_stats("ref", "cw", SW, "event_type")) + (
    f"SELECT {SW}, {r('exp(-chi2 / 2) * (1 + chi2 / 2)', 'p_value')} FROM cat"
)


def report(by: str) -> tuple[str, ...]:
    """Five categories, so the chi-squared tail has its closed form for 4 degrees."""
    return (
        EV, REF, PLANTED, LR, windows("pl", "cw"), long_num("cw", "lw", by), cdf_shared("lr", "lw", by), psi_shared("lr", "lw", by),
        cat_stats("ref", "cw", by, "event_type"),
        f"nc AS (SELECT {by}, count(*) AS n_cur FROM cw GROUP BY ALL)",
        f"d AS (SELECT {by}, feature, max(abs(fa - fb)) AS d, max(n) AS n, max(m) AS m FROM cdf GROUP BY ALL)",
        f"""raw AS (SELECT {by}, feature, 'num' AS kind, d AS stat, {ks_p("d.d", "d.n", "d.m")} AS p, psi AS effect, d.m AS m
  FROM d JOIN psi USING ({by}, feature)
  UNION ALL SELECT {by}, 'event_type', 'cat', chi2, exp(-chi2 / 2) * (1 + chi2 / 2), js * 2.5, m FROM cat)""",
        f"""rep AS (SELECT {by}, feature, kind, CASE WHEN n_cur >= 200 AND m >= 20 THEN stat END AS stat, CASE WHEN n_cur >= 200 AND m >= 20 THEN p END AS p_value,
  CASE WHEN n_cur >= 200 AND m >= 20 THEN effect END AS effect, n_cur >= 200 AND m >= 20 AS measurable,
  (SELECT count(*) FROM ref) AS n_ref, n_cur, n_cur >= 200 AND m >= 20 AND p < {dbl(ALPHA)} AND effect > 0.02 AS drift FROM raw JOIN nc USING ({by}))""",
    )


REPORT_COLUMNS = f"feature, kind, {r('stat', 'stat', 5)}, {r('p_value', 'p_value')}, {r('effect', 'effect')}, measurable, n_ref, n_cur, drift"
ORACLES["drift_report_windows"] = with_(*report(W)) + f"SELECT {W}, {REPORT_COLUMNS} FROM rep"
ORACLES["drift_report_segments"] = with_(*report(SW)) + f"SELECT {SW}, {REPORT_COLUMNS} FROM rep"
GATE = "n_cur >= 200 AND m >= 20"
ORACLES["drift_report_wasserstein"] = with_(EV, REF, PLANTED, LR, windows("pl", "cw"), long_num("cw", "lw", W), cdf_shared("lr", "lw", W),
    f"nc AS (SELECT {W}, count(*) AS n_cur FROM cw GROUP BY ALL)",
    f"d AS (SELECT {W}, feature, max(abs(fa - fb)) AS d, sum(abs(fa - fb) * (nxt - v)) AS w, max(n) AS n, max(m) AS m FROM cdf GROUP BY ALL)",
    f"x AS (SELECT *, {ks_p('d', 'n', 'm')} AS p FROM d JOIN nc USING ({W}))") + f"""
SELECT {W}, feature, {r(f"CASE WHEN {GATE} THEN d END", "stat", 5)}, {r(f"CASE WHEN {GATE} THEN p END", "p_value")}, {r(f"CASE WHEN {GATE} THEN w END", "effect", 5)},
{GATE} AS measurable, n_cur, {GATE} AND p < 0.025 AND w > 1.0 AS drift FROM x"""
SUMMARY = f"""summ AS (SELECT {W}, max(n_cur) AS n_cur, count(*) FILTER (drift) AS n_drift, count(*) FILTER (NOT measurable) AS n_not_measurable,
  max(effect) FILTER (measurable) AS effect_max, coalesce(string_agg(feature, ',' ORDER BY effect DESC, feature) FILTER (drift), '') AS features FROM rep GROUP BY ALL)"""
ORACLES["drift_summary"] = with_(*report(W), SUMMARY) + f"SELECT {W}, n_cur, n_drift, n_not_measurable, {r('effect_max', 'effect_max')}, features FROM summ"

# --- calibration -----------------------------------------------------------
ORACLES["analytic_floor"] = with_(EV, windows("ev", "cw"), "c AS (SELECT \"window\", count(*) AS n FROM cw GROUP BY 1)",
    "r AS (SELECT count(*) AS n_ref FROM ev WHERE day <= 15)") + (
    f"SELECT {W}, n, {r(f'{dbl(Q1)} * (1.0 / n_ref + 1.0 / n)', 'floor')}, {r(f'{dbl(Q6)} * (1.0 / n_ref + 1.0 / n)', 'floor_6')} FROM c, r"
)
ORACLES["threshold_slack"] = with_(EV, "c AS (SELECT day, count(*) AS n FROM ev WHERE day > 15 GROUP BY 1)", "r AS (SELECT count(*) AS n_ref FROM ev WHERE day <= 15)",
    "b AS (" + " UNION ALL ".join(f"SELECT {b} AS bins, {dbl(chi2_quantile(0.95, b - 1))} AS q" for b in (5, 10, 20, 50)) + ")") + (
    f"SELECT CAST(day AS BIGINT) AS day, n, CAST(bins AS BIGINT) AS bins, {r('q * (1.0 / n_ref + 1.0 / n)', 'floor')}, {r('q * 2 / 0.1', 'n_p95', 4)}, "
    f"{r('(bins - 1) * 2 / 0.1', 'n_mean', 4)}, {r('0.1 / (q * (1.0 / n_ref + 1.0 / n))', 'slack', 4)} FROM c, r, b"
)
AA = (EV, REF, reps("ref", "rp"), effects("rp", "rep"), "mx AS (SELECT rep, max(effect) AS e FROM eff GROUP BY rep)",
      "aa AS (SELECT quantile_cont(e, 0.95) AS aa_floor, quantile_cont(e, 0.5) AS aa_median, max(e) AS aa_max, count(*) AS n_repetitions FROM mx)")
ORACLES["aa_random_floor"] = with_(*AA) + f"SELECT {r('aa_floor', 'aa_floor')}, {r('aa_median', 'aa_median')}, {r('aa_max', 'aa_max')}, n_repetitions FROM aa"
ORACLES["aa_effects"] = with_(EV, REF, reps("ref", "rp", 3), effects("rp", "rep")) + f"SELECT CAST(rep AS BIGINT) AS rep, feature, kind, n0, n1, {r('effect', 'effect')} FROM eff"


def block_parts(src: str, n: int) -> tuple[str, ...]:
    return (
        blocks(src, "bl", n), effects("bl", "pair", "bef"), "bm AS (SELECT pair, max(effect) AS e FROM bef GROUP BY pair)",
        "bf AS (SELECT e AS block_floor, pair || '->' || (pair + 1) AS worst_pair FROM bm ORDER BY e DESC, pair LIMIT 1)",
    )


ORACLES["aa_block_floor"] = with_(EV, REF, *block_parts("ref", 4)) + f"SELECT {r('block_floor', 'block_floor')}, worst_pair FROM bf"
ORACLES["block_effects"] = with_(EV, REF, *block_parts("ref", 4)) + f"SELECT CAST(pair AS BIGINT) AS pair, feature, n0, n1, {r('effect', 'effect')} FROM bef"
VERDICT = "CASE WHEN h < 2 THEN 'homogeneous' WHEN h < 5 THEN 'suspect' ELSE 'CONTAMINATED' END"
ORACLES["calibration_record"] = with_(*AA, *block_parts("ref", 2), "nn AS (SELECT count(*) AS n FROM ref)",
    f"""x AS (SELECT *, {dbl(Q2)} * (1.0 / (n // 2) + 1.0 / (n - n // 2)) AS expected, block_floor / ({dbl(Q2)} * 2.0 / (n // 2)) AS h FROM aa, bf, nn)""") + f"""
SELECT n AS n_reference, CAST(2 AS BIGINT) AS k_features, CAST(10 AS BIGINT) AS bins, round(aa_floor, 6) AS aa_floor, round(aa_median, 6) AS aa_median, round(aa_max, 6) AS aa_max,
n_repetitions, round(block_floor, 6) AS block_floor, worst_pair, round(expected, 6) AS analytic_floor, round(aa_floor / expected, 2) AS aa_ratio, round(h, 2) AS homogeneity,
{VERDICT} AS verdict, round(3 * greatest(aa_floor, expected), 6) AS suggested_threshold, h >= 5 AS contaminated FROM x"""
DRIFTING = "dr AS (SELECT * REPLACE (CASE WHEN day > 12 THEN value + 50 ELSE value END AS value) FROM ref)"
ORACLES["homogeneity_index"] = with_(EV, REF, DRIFTING, *block_parts("dr", 3), "nn AS (SELECT count(*) AS n FROM dr)",
    f"""x AS (SELECT *, {dbl(Q2)} * (1.0 / (n // 2) + 1.0 / (n - n // 2)) AS expected, block_floor / ({dbl(Q2)} * 2.0 / (n // 3)) AS h FROM bf, nn)""") + f"""
SELECT round(block_floor, 6) AS block_floor, worst_pair, round(h, 2) AS homogeneity, {VERDICT} AS verdict, round(3 * expected, 6) AS suggested_threshold, h >= 5 AS contaminated FROM x"""
HALVES = (EV, REF, DRIFTING, """hv AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY day, event_id) - 1 < count(*) OVER () // 2 THEN 0 ELSE 1 END AS side FROM dr)""",
    long_num("hv", "hl", "side"), paired_psi("hl", "feature", "hp"),
    f"hb AS (SELECT feature, n0 + n1 AS n, psi / ({dbl(Q1)} * (1.0 / ((n0 + n1) // 2) + 1.0 / (n0 + n1 - (n0 + n1) // 2))) AS h FROM hp)")
ORACLES["homogeneity_by_feature"] = with_(*HALVES) + f"SELECT feature, CAST(n AS BIGINT) AS n, round(h, 2) AS h, {VERDICT} AS verdict FROM hb"
ORACLES["homogeneity_audit"] = with_(*HALVES, reps("dr", "rp"), long_num("rp", "rl", "rep, side"), paired_psi("rl", "rep, feature", "rq"),
    f"""hr AS (SELECT feature, quantile_cont(psi, 0.95) / ({dbl(Q1)} * (1.0 / (max(n0 + n1) // 2) + 1.0 / (max(n0 + n1) - max(n0 + n1) // 2))) AS h FROM rq GROUP BY feature)""") + f"""
SELECT feature, CAST(n AS BIGINT) AS n, round(hb.h, 2) AS h_block, round(hr.h, 2) AS h_random, {VERDICT.replace("h <", "hb.h <")} AS verdict FROM hb JOIN hr USING (feature)"""
ORACLES["audit_summary"] = with_(f"audit AS ({ORACLES['homogeneity_audit']})") + f"""SELECT count(*) AS n_features, count(*) FILTER (h_block > 5) AS n_contaminated, {r("median(h_block)", "h_block_median", 2)},
{r("median(h_random)", "h_random_median", 2)}, max(n) AS n, {r(f"{dbl(Q1)} * 2.0 / (max(n) // 2)", "floor")}, {r(f"0.1 / ({dbl(Q1)} * 2.0 / (max(n) // 2))", "slack", 4)} FROM audit"""
ORACLES["operational_floor"] = with_(EV, "c AS (SELECT day, count(*) AS n FROM ev WHERE day > 15 GROUP BY 1)",
    "x AS (SELECT (SELECT count(*) FROM ev WHERE day <= 15) AS n_ref, CAST(floor(median(n)) AS BIGINT) AS n_window FROM c)",
    f"y AS (SELECT *, {dbl(Q2)} * (1.0 / n_ref + 1.0 / n_window) * 0.93 AS f FROM x)") + f"SELECT n_ref, n_window, {r('f', 'floor')}, {r('f * 3', 'threshold')} FROM y"


def seg_cal(kept: str, name: str) -> str:
    return f"""{name}_n AS (SELECT seg, count(*) AS n FROM ev WHERE {kept} GROUP BY seg),
{name} AS (SELECT seg, n, {dbl(Q2)} * (1.0 / (n // 2) + 1.0 / (n - n // 2)) AS f, seg = 3 AS bad FROM {name}_n)"""


ORACLES["regime_comparison"] = with_(EV, seg_cal("event_type IN ('error', 'signup')", "a"), seg_cal("true", "b"), "x AS (SELECT a.seg, 3 * a.f AS t, a.f AS fa, b.f AS fb, 3 * a.f / b.f AS s, a.bad OR b.bad AS contaminated FROM a JOIN b USING (seg))") + f"""
SELECT seg, round(s, 1) AS threshold_in_floors, round(fb / fa, 3) AS floor_ratio, {r(f"{dbl(Q1)} * 2 / t", "calibrated_for_n", 3)},
CASE WHEN s > 10 THEN 'blind' WHEN s > 3 THEN 'conservative' WHEN s > 1 THEN 'transfers' ELSE 'perpetual alarm' END AS regime, contaminated FROM x"""
ORACLES["contract_violations"] = f"""WITH n AS (SELECT event_type, count(*) AS n, count(*) FILTER (value < 100) AS ok FROM events GROUP BY event_type),
c AS (SELECT event_type, CASE WHEN event_type <> 'view' THEN 0.02 END AS threshold, {dbl(Q1)} * 2.0 / n * CASE WHEN event_type = 'click' THEN 10 ELSE 0.1 END AS floor,
  CASE WHEN event_type = 'error' THEN n ELSE ok END AS total, ok FROM n)
SELECT event_type, 'missing threshold' AS violation FROM c WHERE threshold IS NULL
UNION ALL SELECT event_type, 'threshold inside the floor' FROM c WHERE threshold <= floor
UNION ALL SELECT event_type, 'suite has failures' FROM c WHERE total > 0 AND ok < total"""
ORACLES["edge_periods"] = """WITH c AS (SELECT CAST(floor(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) / 7.0) AS BIGINT) AS week, count(*) AS n FROM orders GROUP BY 1),
k AS (SELECT * FROM c WHERE n > 0.4 * (SELECT median(n) FROM c)) SELECT week, n, row_number() OVER (ORDER BY week) <= 4 AS is_reference FROM k"""

# --- performance -----------------------------------------------------------
EST = "n_pos >= 8 AND n_pos < n"


def shown(expr: str, name: str, digits: int = 5) -> str:
    return f"round(CASE WHEN {EST} THEN {expr} END, {digits}) AS {name}"


PLS = (EV, PLANTED, scored("pl", "sc"), windows("sc", "cw"))
EVS = (EV, scored("ev", "sc"))
ORACLES["roc_auc"] = with_(*PLS, score_groups("cw", SW)) + f"SELECT seg, {W}, n, n_pos, {shown('auc', 'roc_auc')}, {EST} AS estimable FROM sg"
ORACLES["average_precision"] = with_(*EVS, score_groups("sc", "day")) + f"SELECT CAST(day AS BIGINT) AS day, n_pos, {shown('ap', 'average_precision', 6)} FROM sg"
ORACLES["mcc"] = with_(*EVS, score_groups("sc", "day"), mcc_at("sc", "day", "0.45")) + f"SELECT CAST(day AS BIGINT) AS day, {shown('m', 'mcc')} FROM sg JOIN ma USING (day)"
ORACLES["best_mcc_threshold"] = with_(*EVS, score_groups("sc", "seg"), best_mcc("sc", "seg")) + f"SELECT seg, {shown('m', 'mcc', 6)}, {shown('th', 'threshold', 6)} FROM sg JOIN bm USING (seg)"
ORACLES["log_loss"] = with_(*EVS) + f"""SELECT CAST(day AS BIGINT) AS day,
{r("avg(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7))))", "logloss")} FROM sc GROUP BY day"""
ORACLES["performance_by_window"] = with_(*PLS, score_groups("cw", W), best_mcc("cw", W)) + (
    f"SELECT {W}, n, n_pos, {shown('ap', 'pr_auc')}, {shown('auc', 'roc_auc')}, {shown('m', 'mcc')}, {shown('loss', 'logloss')}, {shown('th', 'threshold')}, {EST} AS estimable FROM sg JOIN bm USING ({W})"
)
ORACLES["extended_metrics"] = with_(*EVS, score_groups("sc", "seg"), best_mcc("sc", "seg"),
    "c AS (SELECT seg, sum(y) FILTER (p >= 0.5) AS tp, sum(1 - y) FILTER (p >= 0.5) AS fp, sum(y) AS np, sum(1 - y) AS nn, count(*) AS n FROM sc GROUP BY seg)") + """
SELECT seg, round(np / c.n, 5) AS prevalence, round((tp + nn - fp) / c.n, 5) AS accuracy, round(nn / c.n, 5) AS accuracy_trivial,
round(2 * tp / (2 * tp + fp + np - tp), 5) AS f1_at_half, round(ap, 5) AS pr_auc, round(m, 5) AS best_mcc, round(th, 5) AS best_threshold
FROM sg JOIN bm USING (seg) JOIN c USING (seg)"""
ORACLES["threshold_drift"] = with_(*EVS, score_groups("sc", "day"), best_mcc("sc", "day"),
    f"own AS (SELECT day, th, m FROM sg JOIN bm USING (day) WHERE {EST})", "fx AS (SELECT th AS t FROM own ORDER BY day LIMIT 1)",
    mcc_at("sc, fx", "day", "t")) + """
SELECT CAST(day AS BIGINT) AS day, round(ma.m, 5) AS mcc_fixed, round(own.m, 5) AS mcc_own, round(th, 5) AS own_threshold,
round(round(own.m, 5) - round(ma.m, 5), 5) AS gain FROM own JOIN ma USING (day)"""
ORACLES["capability_index"] = f"""SELECT l_linestatus, {r("least((80 - avg(l_quantity)) / (3 * stddev_samp(l_quantity)), (avg(l_quantity) + 20) / (3 * stddev_samp(l_quantity)))", "cpk")} FROM lineitem GROUP BY 1"""
ORACLES["ppm"] = f"""SELECT l_returnflag, {r("avg(CASE WHEN l_quantity < 3 OR l_quantity > 45 THEN 1.0 ELSE 0.0 END) * 1e6", "ppm", 3)} FROM lineitem GROUP BY 1"""
ORACLES["capability"] = with_(EV, PLANTED, f"x AS (SELECT coalesce({EVENT_CASE}, 'baseline') AS scenario, value FROM pl)",
    """g AS (SELECT scenario, count(*) AS n, avg(value) AS mean, least((250 - avg(value)) / (3 * stddev_samp(value)), (avg(value) + 150) / (3 * stddev_samp(value))) AS c,
  avg(CASE WHEN value < -150 OR value > 250 THEN 1.0 ELSE 0.0 END) * 1e6 AS ppm FROM x GROUP BY 1)""") + (
    f"SELECT scenario, n, {r('mean', 'mean')}, {r('c', 'cpk')}, {r('ppm', 'ppm', 3)}, c >= 1.33 AS conforming FROM g"
)

# --- guards ----------------------------------------------------------------
EVID = """g0 AS (SELECT seg, day, sum(event_id % 97) AS mix FROM ev GROUP BY ALL),
evid AS (SELECT seg, CAST(day AS BIGINT) AS day, CASE WHEN mix % 11 = 0 THEN 5 ELSE 500 END AS n_rows, mix % 3 AS n_drift, (mix % 29) / 100.0 AS effect_max,
  CASE WHEN mix % 17 = 1 THEN 0.5 WHEN mix % 17 = 2 THEN 0.05 END AS worst_fraction, CASE WHEN mix % 7 <> 0 THEN 0.80 END AS auc_global,
  CAST('0.5' AS DOUBLE) + (mix % 5) * CAST('0.07' AS DOUBLE) AS auc_segment, CASE WHEN mix % 2 = 0 THEN ((mix % 13) - 1) / 100.0 END AS gain FROM g0)"""


def causes(src: str, name: str, axis: str) -> str:
    return f"""{name} AS (SELECT *, CASE WHEN worst_fraction > 0.10 THEN 'pipeline'
  WHEN {CONTEXT_CASE.replace("day", axis)} IS NOT NULL THEN 'business'
  WHEN auc_global IS NOT NULL AND auc_segment IS NOT NULL AND greatest(auc_segment - 0.5, 0) / greatest(auc_global - 0.5, 1e-6) < 0.35 AND auc_segment < 0.55
    AND n_drift <= 1 AND (effect_max IS NULL OR effect_max < 10 * {GUARDS.threshold}) THEN 'hardware'
  WHEN n_drift > 0 AND auc_global IS NOT NULL AND auc_segment IS NOT NULL AND auc_global - auc_segment < 0.05 THEN 'business'
  WHEN n_drift > 0 THEN 'model' ELSE 'none' END AS cause FROM {src})"""


def memory(src: str, name: str, axis: str, extra: str = "") -> str:
    key = "seg" + extra
    return f"""{name} AS (SELECT *, n_drift > 0 AS alarmed,
  sum(CASE WHEN n_drift > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY {axis} ROWS BETWEEN {GUARDS.n - 1} PRECEDING AND CURRENT ROW) AS n_alarmed,
  count(*) OVER (PARTITION BY {key} ORDER BY {axis} ROWS BETWEEN {GUARDS.n - 1} PRECEDING AND CURRENT ROW) AS n_windows,
  cause = 'model' AND coalesce(lag(cause) OVER (PARTITION BY {key} ORDER BY {axis}), '') = 'model' AS confirmed,
  lag(cause) OVER (PARTITION BY {key} ORDER BY {axis}) AS previous_cause FROM {src} WHERE n_rows >= 200)"""


def fold(src: str, name: str, axis: str, extra: str = "") -> str:
    """Greedy cooldown over the ordered candidates of each monitor."""
    key = "seg" + extra
    join = "s.seg = f.seg" + (" AND s.epoch = f.epoch" if extra else "")
    skey = "s.seg" + (", s.epoch" if extra else "")
    return f"""{name}_o AS (SELECT {key}, {axis} AS a, row_number() OVER (PARTITION BY {key} ORDER BY {axis}) AS i FROM {src}),
{name} AS (SELECT {key}, a, i, true AS retrains, CAST(NULL AS BIGINT) AS previous, a AS last FROM {name}_o WHERE i = 1
  UNION ALL SELECT {skey}, s.a, s.i, s.a - f.last >= {GUARDS.cooldown}, f.last, CASE WHEN s.a - f.last >= {GUARDS.cooldown} THEN s.a ELSE f.last END
  FROM {name}_o s JOIN {name} f ON {join} AND s.i = f.i + 1)"""


def cascade(src: str, axis: str, extra: str = "") -> str:
    eff = GUARDS.floor_factor * GUARDS.floor
    on = f"c.seg = fd.seg AND c.{axis} = fd.a" + (" AND c.epoch = fd.epoch" if extra else "")
    return f"""{causes(src, "ca", axis)},
{memory("ca", "me", axis, extra)},
st AS (SELECT *, n_alarmed >= {GUARDS.k} AS persistent, coalesce(effect_max > {dbl(eff)}, false) AS above_floor,
  CASE WHEN cause IN ('hardware', 'pipeline') THEN 'blocked' WHEN NOT alarmed THEN 'no alarm' WHEN n_alarmed < {GUARDS.k} THEN 'not persistent'
  WHEN NOT coalesce(effect_max > {dbl(eff)}, false) THEN 'below floor' WHEN cause = 'business' THEN 'known context'
  WHEN cause = 'model' AND NOT confirmed THEN 'cause unconfirmed' WHEN gain < {GUARDS.min_gain} THEN 'shadow failed' ELSE 'candidate' END AS stage FROM me),
{fold("(SELECT * FROM st WHERE stage = 'candidate')", "fd", axis, extra)},
de AS (SELECT c.*, fd.retrains, fd.previous, CASE WHEN stage = 'blocked' THEN 20 WHEN fd.retrains THEN 10 ELSE 0 END AS code,
  CASE WHEN stage <> 'candidate' THEN stage WHEN fd.retrains THEN 'authorised' ELSE 'cooldown' END AS reason FROM st c LEFT JOIN fd ON {on}),
al AS (SELECT seg, {axis} AS axis, code, cause, reason FROM de UNION ALL SELECT seg, {axis}, 30, 'undefined', 'window too small to be judged' FROM {src} WHERE n_rows < 200)"""


ACTION = "CASE code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ACTION_NAMES.items()) + " END AS action"
REC = "WITH RECURSIVE "
ORACLES["cause"] = with_(EV, EVID, causes("evid", "ca", "day")) + "SELECT seg, day, cause FROM ca"
ORACLES["persistence"] = with_(EV, EVID, causes("evid", "ca", "day"), memory("ca", "me", "day")) + (
    f"SELECT seg, day, CAST(n_alarmed AS BIGINT) AS n_alarmed, n_windows, n_alarmed >= {GUARDS.k} AS persistent FROM me"
)
ORACLES["cause_confirmed"] = with_(EV, EVID, causes("evid", "ca", "day"), memory("ca", "me", "day")) + "SELECT seg, day, cause, previous_cause, confirmed AS cause_confirmed FROM me"
ORACLES["cooldown"] = REC + ",\n".join([EV, EVID, fold("(SELECT * FROM evid WHERE n_drift = 2)", "fd", "day")]) + "\nSELECT seg, a AS day, retrains, previous AS previous_retrain FROM fd"
DECIDED = REC + ",\n".join([EV, EVID, cascade("evid", "day")]) + "\n"
ORACLES["decisions"] = DECIDED + f"SELECT seg, axis AS day, {ACTION}, CAST(code AS BIGINT) AS exit_code, cause, reason FROM al"
ORACLES["decision_next"] = ORACLES["decisions"] + " WHERE axis > 20"
ORACLES["stream_guards"] = DECIDED + "SELECT seg, axis AS day, CAST(code AS BIGINT) AS exit_code, cause, reason FROM al"
RESET = "er AS (SELECT *, CASE WHEN seg < 2 AND day >= 12 THEN 1 ELSE 0 END AS epoch FROM evid)"
ORACLES["decision_after_reset"] = REC + ",\n".join([EV, EVID, RESET, cascade("er", "day", ", epoch")]) + "\nSELECT seg, axis AS day, CAST(code AS BIGINT) AS exit_code, reason FROM al"
LATE = "stage IN ('cause unconfirmed', 'shadow failed', 'candidate')"
LABEL = "CASE g " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GUARD_LABELS.items()) + " END"
ORACLES["guard_results"] = DECIDED + f"""SELECT seg, day, {LABEL} AS guard, CASE WHEN ok THEN 'pass' ELSE 'BLOCK' END AS result FROM (
SELECT seg, day, 'lasting' AS g, persistent AS ok FROM de UNION ALL SELECT seg, day, 'above_noise', above_floor FROM de
UNION ALL SELECT seg, day, 'outside_context', cause <> 'business' FROM de UNION ALL SELECT seg, day, 'trainable_cause', cause NOT IN ('hardware', 'pipeline') FROM de
UNION ALL SELECT seg, day, 'cause_repeated', confirmed FROM de WHERE {LATE}
UNION ALL SELECT seg, day, 'challenger_gains', stage = 'candidate' FROM de WHERE stage IN ('shadow failed', 'candidate')) x"""
DAYS = "days AS (" + " UNION ALL ".join(
    f"SELECT '{e['name']}' AS name, {str(e['must_alarm']).lower()} AS must_alarm, {e['exit_code']} AS right_code, d AS d FROM range({e['start']}, {e['end'] + 1}) t(d)" for e in EVENTS
) + ")"
ORACLES["detection_score"] = REC + ",\n".join([EV, EVID, cascade("evid", "day"), DAYS,
    "sc AS (SELECT al.*, coalesce(de.n_drift > 0, false) AS alarmed FROM al LEFT JOIN de ON de.seg = al.seg AND de.day = al.axis)"]) + """
SELECT name, count(*) AS windows, count(*) FILTER (alarmed) AS alarmed, count(*) FILTER (code = 20) AS blocked, count(*) FILTER (code = 10) AS retrained,
count(*) FILTER (alarmed = must_alarm) AS alarm_right, count(*) FILTER (code = right_code) AS action_right FROM sc JOIN days ON axis = d GROUP BY name"""

WINDOW_EVID = (
    *report(W), SUMMARY, violations("pl").replace(windows("pl", "cw") + ", ", "").replace(long_num("cw", "lw", W) + ", ", ""),
    f"wv AS (SELECT {W}, feature AS worst_feature, fraction AS worst_fraction FROM vi WHERE fraction > 0.10 QUALIFY row_number() OVER (PARTITION BY {W} ORDER BY fraction DESC, feature) = 1)",
    scored("pl", "sc"), windows("sc", "sw"), score_groups("sw", W, "ga"), score_groups("sw", SW, "sa"),
    f"""we AS (SELECT sa.seg, summ.{W}, n_cur AS n_rows, n_drift, effect_max, worst_feature, worst_fraction,
  CASE WHEN ga.n_pos >= 8 AND ga.n_pos < ga.n THEN round(ga.auc, 5) END AS auc_global,
  CASE WHEN sa.n > 50 AND sa.n_pos >= 8 AND sa.n_pos < sa.n THEN round(sa.auc, 5) END AS auc_segment, CAST(NULL AS DOUBLE) AS gain
  FROM summ LEFT JOIN wv USING ({W}) JOIN ga USING ({W}) JOIN sa USING ({W}))""",
)
ORACLES["evidence_by_window"] = with_(*WINDOW_EVID) + (
    f"SELECT seg, {W}, n_rows, n_drift, {r('effect_max', 'effect_max')}, worst_feature, {r('worst_fraction', 'worst_fraction')}, auc_global, auc_segment FROM we"
)
ORACLES["monitor_backfill"] = REC + ",\n".join([*WINDOW_EVID, f"wx AS (SELECT * RENAME ({W} AS win) FROM we)", cascade("wx", "win")]) + (
    f"\nSELECT seg, axis AS {W}, {ACTION}, CAST(code AS BIGINT) AS exit_code, cause, reason FROM al"
)

ORACLES["decide_one_window"] = ORACLES["monitor_backfill"]

# --- preparation, planting, streaming ------------------------------------------
ORACLES["topk_per_group"] = """SELECT lang, doc_id, CAST(n_chars AS BIGINT) AS n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) <= 6"""
FAULTY = "seg = 2 AND day BETWEEN 22 AND 25"
ORACLES["expectations"] = with_(EV, PLANTED, scored("pl", "sc"), f"""o AS (SELECT 'reference prevalence' AS "check", (SELECT avg(y) FROM sc WHERE day <= 15) AS v, 0.05 AS lo, 0.45 AS hi
UNION ALL SELECT 'campaign mix', (SELECT avg(CASE WHEN event_type = 'view' THEN 1.0 ELSE 0.0 END) FROM sc WHERE day BETWEEN 19 AND 21), 0.6 - 1e-12, 1e9
UNION ALL SELECT 'sensor reads low', (SELECT avg(real_value - value) FROM sc WHERE {FAULTY}), 2.65, 4.35
UNION ALL SELECT 'other segments untouched', (SELECT max(abs(real_value - value)) FROM sc WHERE seg <> 2 AND day BETWEEN 22 AND 25), -1, 0.01
UNION ALL SELECT 'unit change leaves range', (SELECT avg(CASE WHEN value > 200 THEN 1.0 ELSE 0.0 END) FROM sc WHERE day >= 28), 0.95, 1e9
UNION ALL SELECT 'apparent shift small', abs((SELECT avg(value) FROM sc WHERE {FAULTY}) - (SELECT avg(value) FROM sc WHERE day <= 15)), -1, 10)""") + (
    f'SELECT "check", v > lo AND v < hi AS ok, {r("v", "observed")} FROM o'
)
ORACLES["planted_drift"] = with_(EV, PLANTED) + f"""SELECT CAST(day AS BIGINT) AS day, seg, count(*) AS n, {r("sum(value)", "value", 3)}, {r("sum(real_value)", "real_value", 3)},
count(*) FILTER (event_type = 'view') AS views FROM pl GROUP BY day, seg"""
ORACLES["event_rows"] = with_(EV) + f"SELECT {EVENT_CASE} AS event, count(*) AS n FROM ev GROUP BY 1"
ORACLES["wear_signal"] = """WITH e0 AS (SELECT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS day, sum(event_id % 1009) AS m FROM events GROUP BY ALL),
e1 AS (SELECT user_id, day, CAST(CASE WHEN user_id % 3 = 0 THEN day * 40 + m % 60 ELSE m % 50 END AS DOUBLE) AS x FROM e0),
e2 AS (SELECT user_id, day, list(x) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS l FROM e1),
e3 AS (SELECT user_id, day, len(l) AS n, l, coalesce(list_sum(list_transform(range(2, len(l) + 1), lambda j: len(list_filter(l[1:j - 1], lambda y: y < l[j])))), 0) AS c,
  coalesce(list_sum(list_transform(range(2, len(l) + 1), lambda j: len(list_filter(l[1:j - 1], lambda y: y > l[j])))), 0) AS d FROM e2),
e4 AS (SELECT *, n * (n - 1) / 2.0 AS pairs, n * (n - 1) / 2.0 - c - d AS t, list_max(l) - list_min(l) AS spread,
  list_max(list_transform(range(2, len(l) + 1), lambda j: l[j] - l[j - 1])) AS rise FROM e3)
SELECT user_id, CAST(day AS BIGINT) AS day, CAST(n AS BIGINT) AS points, round(CASE WHEN pairs > 0 AND pairs > t THEN (c - d) / sqrt(pairs * (pairs - t)) END, 6) + 0.0 AS tau,
round(CASE WHEN spread > 0 THEN rise / spread END, 6) + 0.0 AS max_rise FROM e4"""
ORACLES["stream_window_monitor"] = with_(EV, REF, LR, windows("ev", "cw", 18, 30), long_num("cw", "lw", W), psi_shared("lr", "lw", W),
    cat_stats("ref", "cw", W, "event_type"), f"nc AS (SELECT {W}, count(*) AS n_cur FROM cw GROUP BY ALL)",
    f"x AS (SELECT {W}, feature, 'num' AS kind, psi AS e, m FROM psi UNION ALL SELECT {W}, 'event_type', 'cat', js * 2.5, m FROM cat)",
    f"z AS (SELECT {W}, feature, kind, n_cur, CASE WHEN n_cur >= 200 AND m >= 20 THEN e END AS e FROM x JOIN nc USING ({W}))") + (
    f"SELECT {W}, feature, kind, n_cur, {r('e', 'effect')}, e IS NOT NULL AS measurable, coalesce(e > 0.02, false) AS \"over\" FROM z"
)


def critical(dof: str) -> str:
    """The chi-squared value that equal distributions exceed with the monitor's corrected level."""
    return "CASE " + dof + "".join(f" WHEN {k} THEN {dbl(chi2_quantile(1 - ALPHA, k))}" for k in range(1, 13)) + " END"


def counted_evidence(rows: str, by: str) -> tuple[str, ...]:
    """Drift and violations from bins, categories and ranges of the groups ``by`` of ``rows``."""
    g = [b.strip() for b in by.split(",")]
    on = " AND ".join(f"c.{b} = g.{b}" for b in g)
    return (
        windows(rows, "cw"), long_num("cw", "lw", by), psi_shared("lr", "lw", by), cat_stats("ref", "cw", by, "event_type"),
        f"nc AS (SELECT {by}, count(*) AS n_cur FROM cw GROUP BY ALL)",
        f"""nb AS (SELECT {", ".join("g." + b for b in g)}, g.feature, coalesce(r.n, 0)::DOUBLE AS o1, coalesce(c.n, 0)::DOUBLE AS o2, t.n::DOUBLE AS n1, g.m::DOUBLE AS n2
  FROM psi_g g JOIN psi_b b ON g.feature = b.feature JOIN psi_t t ON g.feature = t.feature LEFT JOIN psi_r r ON r.feature = b.feature AND r.bin = b.bin
  LEFT JOIN psi_c c ON c.feature = b.feature AND c.bin = b.bin AND {on} WHERE coalesce(r.n, 0) + coalesce(c.n, 0) > 0)""",
        f"""nx AS (SELECT {by}, feature, count(*) - 1 AS dof, sum(power(o1 - (o1 + o2) * n1 / (n1 + n2), 2) / ((o1 + o2) * n1 / (n1 + n2))
  + power(o2 - (o1 + o2) * n2 / (n1 + n2), 2) / ((o1 + o2) * n2 / (n1 + n2))) AS chi2 FROM nb GROUP BY ALL)""",
        f"""rep AS (SELECT {by}, feature, effect, effect > 0.02 AND chi2 > {critical("dof")} AS drift FROM (
  SELECT {by}, feature, psi AS effect, m, chi2, dof FROM psi JOIN nx USING ({by}, feature)
  UNION ALL SELECT {by}, 'event_type', js * 2.5, m, chi2, c - 1 FROM cat) JOIN nc USING ({by}) WHERE n_cur >= 200 AND m >= 20)""",
        f"summ AS (SELECT {by}, n_cur, count(*) FILTER (drift) AS n_drift, max(effect) AS effect_max FROM nc LEFT JOIN rep USING ({by}) GROUP BY ALL)",
        f"""vi AS (SELECT {by}, feature, avg(CASE WHEN v < 0 OR v > CASE feature WHEN 'value' THEN 200 ELSE 94 END THEN 1.0 ELSE 0.0 END) AS fraction FROM lw GROUP BY ALL)""",
        f"wv AS (SELECT {by}, max(fraction) AS worst_fraction FROM vi WHERE fraction > 0.10 GROUP BY ALL)",
        scored(rows, "sc"), windows("sc", "sw"), score_groups("sw", W, "ga"), score_groups("sw", SW, "sa"),
    )


AUCS = """CASE WHEN ga.n_pos >= 8 AND ga.n_pos < ga.n THEN round(ga.auc, 5) END AS auc_global,
  CASE WHEN sa.n > 50 AND sa.n_pos >= 8 AND sa.n_pos < sa.n THEN round(sa.auc, 5) END AS auc_segment, CAST(NULL AS DOUBLE) AS gain"""
ORACLES["stream_decisions"] = REC + ",\n".join([EV, REF, PLANTED, LR, *counted_evidence("pl", W),
    f"""wx AS (SELECT sa.seg, summ.{W} AS win, n_cur AS n_rows, n_drift, effect_max, worst_fraction, {AUCS}
  FROM summ LEFT JOIN wv USING ({W}) JOIN ga USING ({W}) JOIN sa USING ({W}))""", cascade("wx", "win")]) + (
    f"\nSELECT seg, axis AS {W}, n_rows, CAST(code AS BIGINT) AS exit_code, cause, reason FROM al JOIN (SELECT seg, win AS axis, n_rows FROM wx) USING (seg, axis)"
)
ORACLES["stream_late_windows"] = REC + ",\n".join([EV, REF, PLANTED, LR,
    "sent AS (SELECT * FROM pl WHERE day > 15 AND NOT (seg = 1 AND day BETWEEN 20 AND 23))", "late AS (SELECT * FROM sent WHERE day = 18 AND event_id % 7 = 3)",
    "intime AS (SELECT * FROM sent WHERE NOT (day = 18 AND event_id % 7 = 3))", *counted_evidence("intime", SW),
    f"""grid AS (SELECT seg, w AS {W} FROM (SELECT DISTINCT seg FROM sent UNION ALL SELECT 9), range(18, 31) t(w))""",
    f"""wx AS (SELECT grid.seg, grid.{W} AS win, coalesce(n_cur, 0) AS n_rows, coalesce(n_drift, 0) AS n_drift, effect_max, worst_fraction, {AUCS}
  FROM grid LEFT JOIN summ USING ({SW}) LEFT JOIN wv USING ({SW}) LEFT JOIN ga USING ({W}) LEFT JOIN sa USING ({SW}))""", cascade("wx", "win")]) + (
    f"""\nSELECT seg, axis AS {W}, n_rows, CAST(code AS BIGINT) AS exit_code, cause, reason, CAST(NULL AS BIGINT) AS n_late
FROM al JOIN (SELECT seg, win AS axis, n_rows FROM wx) USING (seg, axis)
UNION ALL SELECT seg, day, NULL, NULL, NULL, NULL, count(*) FROM late GROUP BY seg, day UNION ALL SELECT NULL, day, NULL, NULL, NULL, NULL, count(*) FROM late GROUP BY day"""
)


# Kendall's p-value: without ties from the permutations of n by their inversions, with ties from the normal tail as a power series.
STEPS = ORACLES["wear_signal"].split("\nSELECT user_id, CAST(day")[0].removeprefix("WITH ")
ORACLES["wear_guard"] = f"""WITH RECURSIVE nul AS (SELECT 1 AS n, [1.0::DOUBLE] AS k
  UNION ALL SELECT n + 1, list_transform(range(0, CAST(n * (n + 1) / 2 AS BIGINT) + 1), lambda j: list_sum(k[CAST(greatest(j - n, 0) + 1 AS BIGINT):CAST(j + 1 AS BIGINT)])) FROM nul WHERE n < 8),
{STEPS},
e5 AS (SELECT *, least(c, pairs - c) AS lower, (c - d) / sqrt(pairs * (pairs - t)) AS tau, rise / spread AS max_rise,
  (n * (n - 1) * (2 * n + 5) - list_sum(list_transform(list_distinct(l), lambda v: len(list_filter(l, lambda y: y = v)) * (len(list_filter(l, lambda y: y = v)) - 1) * (2 * len(list_filter(l, lambda y: y = v)) + 5)))) / 18.0 AS variance
  FROM e4 WHERE n >= 2 AND t < pairs),
e6 AS (SELECT *, abs(c - d) / sqrt(2 * variance) AS x FROM e5),
e7 AS (SELECT user_id, n, tau, max_rise, CASE WHEN t = 0 THEN CASE WHEN 2 * lower = pairs THEN 1.0 ELSE least(1.0, 2 * list_sum(k[1:CAST(lower + 1 AS BIGINT)]) / gamma(n + 1)) END
  ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda i: (CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END) * power(x, 2 * i + 1) / (gamma(i + 1) * (2 * i + 1)))) END AS p
  FROM e6 JOIN nul USING (n)),
u AS (SELECT DISTINCT user_id FROM events)
SELECT user_id, count(*) FILTER (n >= 6 AND p < 0.05 AND tau >= 0.6 AND max_rise <= 0.5) AS n_wear, {r("min(p)", "lowest_p")} FROM u LEFT JOIN e7 USING (user_id) GROUP BY user_id"""
