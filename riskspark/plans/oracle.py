"""Oracle SQL (DuckDB dialect) for the registered queries.

Written from the definitions, not from the Spark code paths: AUC as a rank
sum with average ranks, average precision and KS from per-threshold counts,
quantiles with ``quantile_cont``, category variance with ``var_pop``, the split
with a plain ``row_number`` over each whole class.  The views ``customer``,
``orders``, ``lineitem``, ``events``, ``nation``, ``documents``, ``labels`` and
the other fixture tables are assumed registered.
"""

from __future__ import annotations

from ..functions.scoring import DEFAULT_SCORECARD as CARD
from .. import constants as K

D = 6  # report rounding, as in queries.rounded

# Feature table columns in schema order, by type (our mart design).
APP_COLS = ["SK_ID_CURR", "TARGET", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name"]
BUREAU_COLS = ["BURO_N_ORDERS", "BURO_SUM_PRICE", "BURO_SHARE_F", "BURO_N_LINES", "BURO_SHARE_R"]
PREV_COLS = ["PREV_N_ORDERS", "PREV_AVG_PRICE", "PREV_MIN_PRICE", "PREV_MAX_PRICE",
             "PREV_SHARE_URGENT", "PREV_N_OPEN", "PREV_DAYS_FIRST_ORDER", "PREV_DAYS_LAST_ORDER"]
INST_COLS = ["INST_N_LINES", "INST_AVG_DAYS_LATE", "INST_MAX_DAYS_LATE", "INST_SHARE_LATE"]
POS_COLS = ["POS_N_EVENTS", "POS_SHARE_ERROR", "POS_AVG_VALUE", "DAYS_SINCE_EVENT",
            "POS_DAYS_SINCE_LAST_EVENT"]
CC_COLS = ["CC_AVG_DISCOUNT", "CC_MAX_DISCOUNT", "CC_AVG_TAX", "CC_SUM_REVENUE"]
FEATURE_COLS = APP_COLS + BUREAU_COLS + PREV_COLS + INST_COLS + POS_COLS + CC_COLS
DOUBLE_COLS = {"c_acctbal", "BURO_SUM_PRICE", "BURO_SHARE_F", "BURO_SHARE_R", "PREV_AVG_PRICE",
               "PREV_MIN_PRICE", "PREV_MAX_PRICE", "PREV_SHARE_URGENT", "INST_AVG_DAYS_LATE",
               "INST_SHARE_LATE", "POS_SHARE_ERROR", "POS_AVG_VALUE", "CC_AVG_DISCOUNT",
               "CC_MAX_DISCOUNT", "CC_AVG_TAX", "CC_SUM_REVENUE"}
STRING_COLS = {"c_mktsegment", "n_name"}
DAYS_COLS = [c for c in FEATURE_COLS if "DAYS_" in c]
NUMERIC_COLS = [c for c in FEATURE_COLS if c not in STRING_COLS]
MODEL_NUMERIC = [c for c in NUMERIC_COLS if c not in ("SK_ID_CURR", "TARGET", "c_acctbal")]

_MARTS = """
app AS (
  SELECT c.c_custkey AS SK_ID_CURR, CAST(c.c_acctbal < 0 AS INTEGER) AS TARGET,
         c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
bureau AS (
  SELECT o.o_custkey AS SK_ID_CURR,
         CAST(count(*) AS BIGINT) AS BURO_N_ORDERS,
         CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100e0 AS BURO_SUM_PRICE,
         avg(CASE WHEN o.o_orderstatus = 'F' THEN 1e0 ELSE 0e0 END) AS BURO_SHARE_F,
         CAST(sum(coalesce(b.n_lines, 0)) AS BIGINT) AS BURO_N_LINES,
         CAST(sum(b.n_r) AS DOUBLE) / sum(b.n_lines) AS BURO_SHARE_R
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_r
    FROM lineitem GROUP BY l_orderkey) b ON o.o_orderkey = b.l_orderkey
  GROUP BY o.o_custkey
),
prev AS (
  SELECT o_custkey AS SK_ID_CURR,
         CAST(count(*) AS BIGINT) AS PREV_N_ORDERS,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100e0 / count(*) AS PREV_AVG_PRICE,
         min(o_totalprice) AS PREV_MIN_PRICE,
         max(o_totalprice) AS PREV_MAX_PRICE,
         avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1e0 ELSE 0e0 END) AS PREV_SHARE_URGENT,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS PREV_N_OPEN,
         CAST(min(date_diff('day', DATE '2002-01-01', CAST(o_orderdate AS DATE))) AS INTEGER) AS PREV_DAYS_FIRST_ORDER,
         CAST(max(date_diff('day', DATE '2002-01-01', CAST(o_orderdate AS DATE))) AS INTEGER) AS PREV_DAYS_LAST_ORDER
  FROM orders GROUP BY o_custkey
),
lines AS (
  SELECT o.o_custkey, l.l_discount, l.l_tax, l.l_extendedprice,
         date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS dd
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
),
inst AS (
  SELECT o_custkey AS SK_ID_CURR,
         CAST(count(*) AS BIGINT) AS INST_N_LINES,
         avg(dd) AS INST_AVG_DAYS_LATE,
         CAST(max(dd) AS INTEGER) AS INST_MAX_DAYS_LATE,
         avg(CASE WHEN dd > 60 THEN 1e0 ELSE 0e0 END) AS INST_SHARE_LATE
  FROM lines GROUP BY o_custkey
),
ev AS (
  SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_error,
         sum(CAST(round(value * 100) AS BIGINT)) AS sum_value_cents,
         max(date_diff('day', CAST(ts AS DATE), DATE '2024-01-31')) AS max_since,
         min(date_diff('day', CAST(ts AS DATE), DATE '2024-01-31')) AS min_since
  FROM events GROUP BY user_id
),
pos AS (
  SELECT c.c_custkey AS SK_ID_CURR,
         CAST(coalesce(ev.n, 0) AS BIGINT) AS POS_N_EVENTS,
         CAST(ev.n_error AS DOUBLE) / ev.n AS POS_SHARE_ERROR,
         CAST(ev.sum_value_cents AS DOUBLE) / ev.n / 100e0 AS POS_AVG_VALUE,
         CAST(coalesce(ev.max_since, 365243) AS INTEGER) AS DAYS_SINCE_EVENT,
         CAST(coalesce(ev.min_since, 365243) AS INTEGER) AS POS_DAYS_SINCE_LAST_EVENT
  FROM customer c LEFT JOIN ev ON c.c_custkey = ev.user_id
),
cc AS (
  SELECT o_custkey AS SK_ID_CURR,
         CAST(sum(CAST(round(l_discount * 10000) AS BIGINT)) AS DOUBLE) / count(*) / 10000e0 AS CC_AVG_DISCOUNT,
         max(l_discount) AS CC_MAX_DISCOUNT,
         CAST(sum(CAST(round(l_tax * 10000) AS BIGINT)) AS DOUBLE) / count(*) / 10000e0 AS CC_AVG_TAX,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                  * (10000 - CAST(round(l_discount * 10000) AS BIGINT))) AS DOUBLE) / 1000000e0 AS CC_SUM_REVENUE
  FROM lines GROUP BY o_custkey
)"""


def _raw_features() -> str:
    sel = ", ".join(
        [f"app.{c}" for c in APP_COLS] + [f"bureau.{c}" for c in BUREAU_COLS]
        + [f"prev.{c}" for c in PREV_COLS] + [f"inst.{c}" for c in INST_COLS]
        + [f"pos.{c}" for c in POS_COLS] + [f"cc.{c}" for c in CC_COLS])
    return f""",
raw_features AS (
  SELECT {sel}
  FROM app
  LEFT JOIN bureau ON app.SK_ID_CURR = bureau.SK_ID_CURR
  LEFT JOIN prev ON app.SK_ID_CURR = prev.SK_ID_CURR
  LEFT JOIN inst ON app.SK_ID_CURR = inst.SK_ID_CURR
  LEFT JOIN pos ON app.SK_ID_CURR = pos.SK_ID_CURR
  LEFT JOIN cc ON app.SK_ID_CURR = cc.SK_ID_CURR
)"""


def _features() -> str:
    rep = ", ".join(f"nullif({c}, 365243) AS {c}" for c in DAYS_COLS)
    return f""",
features AS (SELECT * REPLACE ({rep}) FROM raw_features)"""


def _split() -> str:
    return """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY TARGET ORDER BY md5('42|' || CAST(SK_ID_CURR AS VARCHAR)),
                                                     SK_ID_CURR) AS rk,
         count(*) OVER (PARTITION BY TARGET) AS n_class
  FROM features WHERE TARGET IS NOT NULL
),
split AS (
  SELECT * EXCLUDE (rk, n_class, n_test),
         CASE WHEN rk <= n_test THEN 'test' ELSE 'train' END AS split,
         CASE WHEN rk > n_test THEN CAST((rk - n_test - 1) % 5 AS INTEGER) END AS fold
  FROM (SELECT *, CAST(round_even(n_class * 0.2e0, 0) AS BIGINT) AS n_test FROM ranked)
)"""


def _scores() -> str:
    z = ("(-2.2e0 + -0.25e0 * (PREV_N_ORDERS - 10) + 0.00001e0 * (PREV_AVG_PRICE - 250000))")
    return f""",
prob AS (SELECT SK_ID_CURR, TARGET, split, 1e0 / (1e0 + exp(-{z})) AS probability FROM split),
clipped AS (
  SELECT *, CASE WHEN probability IS NULL OR isnan(probability) THEN NULL
                 ELSE greatest({CARD.p_min!r}, least({CARD.p_max!r}, probability)) END AS pc
  FROM prob
),
scored AS (
  SELECT SK_ID_CURR, probability, TARGET, split,
         CAST(round_even({CARD.offset!r} + {CARD.factor!r} * ln((1e0 - pc) / pc), 0) AS INTEGER) AS score
  FROM clipped
),
scores AS (
  SELECT SK_ID_CURR, probability, score,
         CASE WHEN score IS NULL THEN 'Unknown' WHEN score < 450 THEN 'Very High Risk'
              WHEN score < 550 THEN 'High Risk' WHEN score < 650 THEN 'Medium Risk'
              WHEN score < 750 THEN 'Low Risk' ELSE 'Very Low Risk' END AS risk_band,
         TARGET, split
  FROM scored
),
test AS (SELECT * FROM scores WHERE split = 'test')"""


def _with(*parts: str) -> str:
    return "WITH " + _MARTS + "".join(parts) + "\n"


def _round_cols(cols, doubles, prefix="") -> str:
    return ", ".join(f"round({prefix}{c}, {D}) AS {c}" if c in doubles else f"{prefix}{c}" for c in cols)


FEATURES = _with(_raw_features(), _features())
SPLIT = _with(_raw_features(), _features(), _split())
SCORES = _with(_raw_features(), _features(), _split(), _scores())


def _mart(name: str, cols: list[str]) -> str:
    return "WITH " + _MARTS + f"\nSELECT SK_ID_CURR, {_round_cols(cols, DOUBLE_COLS)} FROM {name}"


def _rank_sum_auc(long_rel: str, group: str) -> str:
    """AUC per group from the Mann-Whitney rank sum (average ranks on ties)."""
    return f"""
auc_in AS ({long_rel}),
auc_ranked AS (
  SELECT {group}, v, y,
         rank() OVER (PARTITION BY {group} ORDER BY v) + (count(*) OVER (PARTITION BY {group}, v) - 1) / 2e0 AS r
  FROM auc_in
),
auc AS (
  SELECT {group}, count(*) AS n,
         sum(y) AS P, count(*) - sum(y) AS N,
         CASE WHEN sum(y) > 0 AND count(*) - sum(y) > 0 THEN
           (sum(CASE WHEN y = 1 THEN r ELSE 0e0 END) - sum(y) * (sum(y) + 1) / 2e0) / (sum(y) * (count(*) - sum(y)))
         END AS auc
  FROM auc_ranked GROUP BY {group}
)"""


def _audit(source: str, cols: list[str], label: str = "TARGET") -> str:
    union = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS v, CAST({label} AS BIGINT) AS y FROM {source} "
        f"WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)) AND {label} IS NOT NULL"
        for c in cols)
    names = " UNION ALL ".join(f"SELECT '{c}' AS column_name" for c in cols)
    return f""",{_rank_sum_auc(union, 'column_name')},
names AS ({names})
SELECT names.column_name,
       CAST(coalesce(auc.n, 0) AS BIGINT) AS n_values,
       round(CASE WHEN coalesce(auc.n, 0) >= 100 THEN auc.auc END, {D}) AS auc,
       round(CASE WHEN coalesce(auc.n, 0) >= 100 THEN greatest(auc.auc, 1 - auc.auc) END, {D}) AS auc_folded,
       coalesce(CASE WHEN coalesce(auc.n, 0) >= 100 THEN greatest(auc.auc, 1 - auc.auc) END > 0.99, false) AS suspicious,
       CASE WHEN coalesce(auc.n, 0) < 100 THEN 'too_few_values'
            WHEN auc.auc IS NULL THEN 'one_class' ELSE 'ok' END AS status
FROM names LEFT JOIN auc ON names.column_name = auc.column_name
"""


def _ranking(rel: str, score: str, group: str | None) -> str:
    """AUC (rank sum), AP and KS from per-threshold counts, per group."""
    g = group or "'all'"
    gsel = f"auc.grp AS {group}, " if group else ""
    long_rel = f"SELECT {g} AS grp, CAST({score} AS DOUBLE) AS v, CAST(TARGET AS BIGINT) AS y FROM {rel} " \
               f"WHERE TARGET IS NOT NULL AND {score} IS NOT NULL"
    return f""",{_rank_sum_auc(long_rel, 'grp')},
thr AS (
  SELECT grp, v, sum(y) AS pos, count(*) - sum(y) AS neg FROM auc_in GROUP BY grp, v
),
cum AS (
  SELECT grp, v, pos, neg,
         sum(pos) OVER (PARTITION BY grp ORDER BY v DESC) AS tp,
         sum(neg) OVER (PARTITION BY grp ORDER BY v DESC) AS fp,
         sum(pos) OVER (PARTITION BY grp) AS P, sum(neg) OVER (PARTITION BY grp) AS N
  FROM thr
),
apks AS (
  SELECT grp, sum(pos / P * (tp / (tp + fp))) AS ap, max(abs(tp / P - fp / N)) AS ks,
         min(P) AS P, min(N) AS N
  FROM cum GROUP BY grp
)
SELECT {gsel}round(auc.auc, {D}) AS auc_roc,
       round(CASE WHEN apks.P > 0 AND apks.N > 0 THEN apks.ap END, {D}) AS pr_auc,
       round(CASE WHEN apks.P > 0 AND apks.N > 0 THEN apks.ks END, {D}) AS ks_statistic,
       round(2 * auc.auc - 1, {D}) AS gini
FROM auc JOIN apks ON auc.grp = apks.grp
"""


def _decile_sql() -> str:
    probs = ", ".join(f"{i / 10!r}" for i in range(11))
    return SCORES + f""",
edges AS (SELECT DISTINCT unnest(quantile_cont(CAST(score AS DOUBLE), [{probs}])) AS x FROM test WHERE score IS NOT NULL),
-- intervals between neighbouring edges, closed on the right, the lowest on both sides
intervals AS (SELECT row_number() OVER (ORDER BY x) - 1 AS decile, x AS lo, lead(x) OVER (ORDER BY x) AS hi FROM edges),
binned AS (
  SELECT t.*, i.decile FROM test t
  JOIN intervals i ON t.score <= i.hi AND (t.score > i.lo OR (i.decile = 0 AND t.score = i.lo))
),
dec AS (
  SELECT CAST(decile AS INTEGER) AS decile, count(TARGET) AS count, CAST(sum(TARGET) AS BIGINT) AS default_count,
         avg(CAST(TARGET AS DOUBLE)) AS default_rate, min(score) AS min_score, max(score) AS max_score,
         avg(CAST(score AS DOUBLE)) AS avg_score
  FROM binned WHERE decile IS NOT NULL GROUP BY decile
),
dec_flag AS (
  SELECT *, coalesce(default_rate > lag(default_rate) OVER (ORDER BY decile) + 0.005e0, false) AS monotone_violation
  FROM dec
)"""


def _hist_sql(joint: bool, n: int = K.HIST_BINS) -> str:
    rng = ("SELECT s.split, r.lo, r.hi FROM (SELECT DISTINCT split FROM scores WHERE score IS NOT NULL) s, "
           "(SELECT min(CAST(score AS DOUBLE)) AS lo, max(CAST(score AS DOUBLE)) AS hi FROM scores "
           "WHERE score IS NOT NULL) r") if joint else \
          ("SELECT split, min(CAST(score AS DOUBLE)) AS lo, max(CAST(score AS DOUBLE)) AS hi "
           "FROM scores WHERE score IS NOT NULL GROUP BY split")
    return SCORES + f""",
rng0 AS ({rng}),
rng AS (SELECT split, CASE WHEN lo = hi THEN lo - 0.5e0 ELSE lo END AS lo,
               CASE WHEN lo = hi THEN hi + 0.5e0 ELSE hi END AS hi FROM rng0),
grid AS (
  SELECT split, CAST(i AS INTEGER) AS bin, i * ((hi - lo) / {n}) + lo AS lo,
         CASE WHEN i = {n - 1} THEN hi ELSE (i + 1) * ((hi - lo) / {n}) + lo END AS hi
  FROM rng, range({n}) t(i)
),
-- intervals closed on the left, the last on both sides
binned AS (
  SELECT s.split, g.bin FROM scores s JOIN grid g ON s.split = g.split
    AND s.score >= g.lo AND (s.score < g.hi OR (g.bin = {n - 1} AND s.score = g.hi))
),
cnt AS (SELECT split, bin, count(*) AS c FROM binned GROUP BY split, bin),
tot AS (SELECT split, count(*) AS t FROM binned GROUP BY split)
SELECT g.split, g.bin, round(g.lo, {D}) AS lo, round(g.hi, {D}) AS hi,
       CAST(coalesce(c.c, 0) AS BIGINT) AS count
       {", round(CASE WHEN g.hi - g.lo > 0 THEN coalesce(c.c, 0) / (tot.t * (g.hi - g.lo)) END, " + str(D) + ") AS density" if not joint else ""}
FROM grid g LEFT JOIN cnt c ON g.split = c.split AND g.bin = c.bin
LEFT JOIN tot ON g.split = tot.split
"""


def _psi_sql(n: int = K.PSI_BINS) -> str:
    return SCORES + f""",
v AS (SELECT CAST(score AS DOUBLE) AS x, split FROM scores WHERE score IS NOT NULL),
rng AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
grid AS (SELECT CAST(i AS INTEGER) AS bin, i * ((hi - lo) / {n}) + lo AS lo,
                CASE WHEN i = {n - 1} THEN hi ELSE (i + 1) * ((hi - lo) / {n}) + lo END AS hi FROM rng, range({n}) t(i)),
binned AS (SELECT v.split, g.bin FROM v JOIN grid g ON v.x >= g.lo AND (v.x < g.hi OR (g.bin = {n - 1} AND v.x = g.hi))),
cnt AS (SELECT bin, count(*) FILTER (WHERE split = 'train') AS n_e, count(*) FILTER (WHERE split = 'test') AS n_a
        FROM binned GROUP BY bin),
tot AS (SELECT count(*) FILTER (WHERE split = 'train') AS t_e, count(*) FILTER (WHERE split = 'test') AS t_a FROM v),
shares AS (
  SELECT g.bin, g.lo, g.hi,
         greatest(CAST(coalesce(c.n_e, 0) AS DOUBLE) / tot.t_e, {K.PSI_FLOOR!r}) AS ep,
         greatest(CAST(coalesce(c.n_a, 0) AS DOUBLE) / tot.t_a, {K.PSI_FLOOR!r}) AS ap
  FROM grid g LEFT JOIN cnt c ON g.bin = c.bin, tot
),
psi AS (SELECT *, (ap - ep) * ln(ap / ep) AS psi_raw FROM shares)"""


def _psi_bins() -> str:
    return _psi_sql() + """
SELECT bin, CAST(CAST(round_even(lo, 0) AS BIGINT) AS VARCHAR) || '–' || CAST(CAST(round_even(hi, 0) AS BIGINT) AS VARCHAR) AS bin_label,
       round(ep * 100e0, 2) AS expected_pct, round(ap * 100e0, 2) AS actual_pct, round(psi_raw, 4) AS psi
FROM psi
"""


def _psi_summary() -> str:
    return _psi_sql() + f"""
SELECT round(sum(psi_raw), {D}) AS psi_total,
       CASE WHEN sum(psi_raw) < 0.1 THEN 'Stable' WHEN sum(psi_raw) < 0.25 THEN 'Moderate Shift'
            ELSE 'Significant Shift' END AS verdict
FROM psi
"""


def _train_params() -> str:
    """Exact medians (quantile_cont), then mean and population std of the imputed column."""
    parts = []
    for c in MODEL_NUMERIC:
        parts.append(f"""SELECT '{c}' AS column_name, m.med AS median,
       avg(coalesce(CAST({c} AS DOUBLE), m.med)) AS mean,
       CASE WHEN stddev_pop(coalesce(CAST({c} AS DOUBLE), m.med)) > 0
            THEN stddev_pop(coalesce(CAST({c} AS DOUBLE), m.med)) ELSE 1e0 END AS scale
FROM train, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med FROM train) m GROUP BY m.med""")
    return SPLIT + ",\ntrain AS (SELECT * FROM split WHERE split = 'train'),\nparams AS (\n" \
        + "\nUNION ALL\n".join(parts) + "\n)"


def _numeric_params() -> str:
    return _train_params() + f"""
SELECT column_name, round(median, {D}) AS median, round(mean, {D}) AS mean, round(scale, {D}) AS scale FROM params
"""


def _target_stats() -> str:
    """Target encoding per definition: shrink the category mean towards the
    overall mean by lambda = V n / (V n + var_pop(category))."""
    return """,
tr AS (SELECT fold, coalesce(n_name, chr(0) || 'null') AS cat, CAST(TARGET AS DOUBLE) AS y FROM train),
gstats AS (SELECT avg(y) AS M, var_pop(y) AS V FROM tr),
full_enc AS (
  SELECT cat, CASE WHEN V * count(*) + var_pop(y) = 0 THEN M
                   ELSE (V * count(*) / (V * count(*) + var_pop(y))) * avg(y)
                        + (1 - V * count(*) / (V * count(*) + var_pop(y))) * M END AS enc
  FROM tr, gstats GROUP BY cat, M, V
),
folds AS (SELECT DISTINCT fold FROM tr),
rest_glob AS (SELECT f.fold, avg(t.y) AS M, var_pop(t.y) AS V FROM folds f JOIN tr t ON t.fold <> f.fold GROUP BY f.fold),
rest_cat AS (
  SELECT f.fold, t.cat, count(*) AS n, avg(t.y) AS m, var_pop(t.y) AS s2
  FROM folds f JOIN tr t ON t.fold <> f.fold GROUP BY f.fold, t.cat
),
oof_enc AS (
  SELECT k.fold, k.cat,
         CASE WHEN rc.n IS NULL THEN g.M WHEN g.V * rc.n + rc.s2 = 0 THEN g.M
              ELSE (g.V * rc.n / (g.V * rc.n + rc.s2)) * rc.m + (1 - g.V * rc.n / (g.V * rc.n + rc.s2)) * g.M END AS enc
  FROM (SELECT DISTINCT fold, cat FROM tr) k
  JOIN rest_glob g ON k.fold = g.fold
  LEFT JOIN rest_cat rc ON k.fold = rc.fold AND k.cat = rc.cat
)"""


def _target_encoding() -> str:
    return SPLIT + ",\ntrain AS (SELECT * FROM split WHERE split = 'train')" + _target_stats() + f"""
SELECT 'n_name' AS column_name, cat AS category, CAST(NULL AS INTEGER) AS fold, round(enc, {D}) AS encoding FROM full_enc
UNION ALL
SELECT 'n_name', cat, fold, round(enc, {D}) FROM oof_enc
"""


def _encoded_features() -> str:
    num = ",\n  ".join(
        f"round((coalesce(CAST(s.{c} AS DOUBLE), (SELECT median FROM params WHERE column_name = '{c}')) "
        f"- (SELECT mean FROM params WHERE column_name = '{c}')) / "
        f"(SELECT scale FROM params WHERE column_name = '{c}'), {D}) AS {c}" for c in MODEL_NUMERIC)
    return _train_params() + _target_stats() + f""",
seg AS (SELECT DISTINCT coalesce(c_mktsegment, 'missing') AS v FROM train)
SELECT s.SK_ID_CURR, s.TARGET, s.split, s.fold,
  {num},
  {{ONEHOT}},
  round(CASE WHEN s.split = 'train' THEN coalesce(o.enc, rg.M)
             ELSE coalesce(fe.enc, (SELECT M FROM gstats)) END, {D}) AS n_name
FROM split s
LEFT JOIN full_enc fe ON coalesce(s.n_name, chr(0) || 'null') = fe.cat
LEFT JOIN oof_enc o ON s.fold = o.fold AND coalesce(s.n_name, chr(0) || 'null') = o.cat
LEFT JOIN rest_glob rg ON s.fold = rg.fold
"""


def encoded_features_sql(segments: list[str]) -> str:
    """The one-hot columns need the train categories as names."""
    oh = ",\n  ".join(
        f"CASE WHEN coalesce(s.c_mktsegment, 'missing') = '{v}' THEN 1e0 ELSE 0e0 END AS \"c_mktsegment_{v}\""
        for v in segments)
    return _encoded_features().replace("{ONEHOT}", oh)


# Fixed: the five segments of the fixture data (one-hot column names).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _cards() -> str:
    return SCORES + f"""
SELECT t.SK_ID_CURR, t.score, t.risk_band, round(t.probability, {D}) AS probability,
       format('{{:.2f}}', t.probability * 100e0) || '%' AS probability_text,
       CASE WHEN t.TARGET = 1 THEN 'Defaulted' WHEN t.TARGET = 0 THEN 'Repaid' ELSE 'Unknown' END AS outcome,
       coalesce(format('{{:,.0f}}', f.c_acctbal), 'N/A') AS balance,
       coalesce(CAST(f.PREV_N_ORDERS AS VARCHAR), 'N/A') AS orders,
       coalesce(format('{{:,.0f}}', f.PREV_AVG_PRICE), 'N/A') AS average_order,
       coalesce(CAST(round(abs(f.PREV_DAYS_FIRST_ORDER) / 365.25e0, 1) AS VARCHAR), 'N/A') AS years_since_first_order
FROM test t LEFT JOIN features f ON t.SK_ID_CURR = f.SK_ID_CURR
"""


def _catalog() -> str:
    from ..session import TABLES
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST((SELECT count(*) FROM {t}) AS BIGINT) AS n_rows, "
        f"CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS BIGINT) AS n_columns"
        for t in TABLES)


def _doc_audit() -> str:
    return """WITH docs AS (
  SELECT d.doc_id AS SK_ID_CURR, d.lang, d.source, d.n_chars, l.toxic AS TARGET
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)""" + _audit("docs", ["n_chars"])


def numpy_rounding(sql: str) -> str:
    """Rewrite every ``round(x, d)`` as ``round_even(x * 10^d, 0) / 10^d``:
    numpy's rounding, which the Spark side uses too (rint of the scaled value)."""
    out, i = [], 0
    low = sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, last_comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                last_comma = k
            k += 1
        if last_comma is None:
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        arg = numpy_rounding(sql[j + 6:last_comma])
        d = int(sql[last_comma + 1:k].strip())
        out.append(sql[i:j])
        out.append(f"(round_even(({arg}) * 1e{d}, 0) / 1e{d} + 0e0)")
        i = k + 1


def oracle_queries() -> dict[str, str]:
    return {k: numpy_rounding(v) for k, v in _oracle_queries().items()}


def _oracle_queries() -> dict[str, str]:
    feat_sel = _round_cols(FEATURE_COLS, DOUBLE_COLS)
    miss = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR isnan({c})" if c in DOUBLE_COLS else "") + ") AS n, count(*) AS t FROM features"
        for c in FEATURE_COLS)
    return {
        "features": FEATURES + f"SELECT {feat_sel} FROM features",
        "mart_bureau": _mart("bureau", BUREAU_COLS),
        "mart_previous_app": _mart("prev", PREV_COLS),
        "mart_installments": _mart("inst", INST_COLS),
        "mart_pos_cash": _mart("pos", POS_COLS),
        "mart_credit_card": _mart("cc", CC_COLS),
        "sentinel_counts": _with(_raw_features()) + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} = 365243) AS BIGINT) AS n_sentinel "
            f"FROM raw_features" for c in DAYS_COLS),
        "missingness": FEATURES + f", m AS ({miss})\nSELECT column_name, CAST(n AS BIGINT) AS n_missing, "
                                  "round(n / t * 100e0, 2) AS pct_missing FROM m",
        "top_missing": FEATURES + f", m AS ({miss})\nSELECT column_name, CAST(n AS BIGINT) AS n_missing, "
                                  "round(n / t * 100e0, 2) AS pct_missing FROM m WHERE n > 0 "
                                  "ORDER BY n DESC, column_name LIMIT 50",
        "target_distribution": FEATURES + "SELECT TARGET, count(*) AS count, "
                                          "round(count(*) / (SELECT count(*) FROM features) * 100e0, 2) AS pct "
                                          "FROM features WHERE TARGET IS NOT NULL GROUP BY TARGET",
        "column_cardinality": FEATURES + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, "
            f"CASE WHEN count(DISTINCT {c}) < 10 THEN 'low' ELSE 'high' END AS cardinality FROM features"
            for c in ["c_mktsegment", "n_name"]),
        "leakage_audit": FEATURES + _audit("features", [c for c in NUMERIC_COLS
                                                         if c not in ("SK_ID_CURR", "TARGET")]),
        "document_cardinality": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, "
            f"CASE WHEN count(DISTINCT {c}) < 10 THEN 'low' ELSE 'high' END AS cardinality FROM documents"
            for c in ["lang", "source"]),
        "document_leakage_audit": _doc_audit(),
        "catalog_summary": _catalog(),
        "split_assignment": SPLIT + "SELECT SK_ID_CURR, TARGET, split, fold FROM split",
        "class_balance": SPLIT + "SELECT split, CAST(sum(TARGET) AS BIGINT) AS n_pos, count(*) AS n_total, "
                                 "round(sum(TARGET) / count(*) * 100e0, 2) AS pct_pos FROM split GROUP BY split",
        "class_ratio": SPLIT + f"SELECT count(*) FILTER (WHERE TARGET = 0) AS n_neg, "
                               f"count(*) FILTER (WHERE TARGET = 1) AS n_pos, "
                               f"round(CAST(count(*) FILTER (WHERE TARGET = 0) AS DOUBLE) / "
                               f"count(*) FILTER (WHERE TARGET = 1), {D}) AS scale_pos_weight "
                               f"FROM split WHERE split = 'train'",
        "formula_scores": SCORES + f"SELECT SK_ID_CURR, round(probability, {D}) AS probability, score, "
                                   f"risk_band, TARGET, split FROM scores",
        "score_deciles": _decile_sql() + f"\nSELECT decile, count, default_count, round(default_rate, {D}) "
                                         f"AS default_rate, min_score, max_score, round(avg_score, {D}) AS avg_score, "
                                         f"monotone_violation FROM dec_flag",
        "score_monotonicity": _decile_sql() + "\nSELECT coalesce(bool_and(NOT monotone_violation), true) "
                                              "AS is_monotone FROM dec_flag",
        "score_summary": SCORES + f"""SELECT split, min(score) AS min_score, max(score) AS max_score,
  round(avg(CAST(score AS DOUBLE)), {D}) AS mean_score, round(stddev_pop(CAST(score AS DOUBLE)), {D}) AS std_score,
  round(quantile_cont(CAST(score AS DOUBLE), 0.25), {D}) AS p25,
  round(quantile_cont(CAST(score AS DOUBLE), 0.5), {D}) AS p50,
  round(quantile_cont(CAST(score AS DOUBLE), 0.75), {D}) AS p75
FROM scores WHERE score IS NOT NULL GROUP BY split""",
        "band_distribution": SCORES + """, grid AS (
  SELECT * FROM (VALUES ('Very Low Risk', 0), ('Low Risk', 1), ('Medium Risk', 2), ('High Risk', 3),
                        ('Very High Risk', 4), ('Unknown', 5)) g(risk_band, band_order))
SELECT g.risk_band, CAST(g.band_order AS INTEGER) AS band_order,
       CAST(count(t.SK_ID_CURR) AS BIGINT) AS count,
       round(count(t.SK_ID_CURR) / (SELECT count(*) FROM test) * 100e0, 2) AS pct
FROM grid g LEFT JOIN test t ON g.risk_band = t.risk_band GROUP BY g.risk_band, g.band_order""",
        "band_value_counts": SCORES + "SELECT risk_band, count(*) AS count FROM test GROUP BY risk_band",
        "score_histogram": _hist_sql(joint=False),
        "score_histogram_joint": _hist_sql(joint=True),
        "psi_bins": _psi_bins(),
        "psi_summary": _psi_summary(),
        "ranking_metrics": SCORES + _ranking("scores", "probability", "split").replace(
            "FROM auc JOIN apks ON auc.grp = apks.grp",
            "FROM auc JOIN apks ON auc.grp = apks.grp JOIN (SELECT split, round(avg(CAST(TARGET AS DOUBLE)), "
            f"{D}) AS base_rate FROM scores GROUP BY split) b ON auc.grp = b.split").replace(
            "round(2 * auc.auc - 1, 6) AS gini", "round(2 * auc.auc - 1, 6) AS gini, b.base_rate"),
        "score_ranking_metrics": SCORES + _ranking("(SELECT *, -score AS risk FROM test)", "risk", None),
        "roc_curve": SCORES + f""", thr AS (
  SELECT CAST(probability AS DOUBLE) AS v, sum(TARGET) AS pos, count(*) - sum(TARGET) AS neg
  FROM test WHERE probability IS NOT NULL AND TARGET IS NOT NULL GROUP BY 1),
cum AS (SELECT v, sum(pos) OVER (ORDER BY v DESC) AS tp, sum(neg) OVER (ORDER BY v DESC) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM thr)
SELECT round(v, {D}) AS threshold, round(fp / N, {D}) AS fpr, round(tp / P, {D}) AS tpr FROM cum
UNION ALL SELECT NULL, 0e0, 0e0""",
        "pr_curve": SCORES + f""", thr AS (
  SELECT CAST(probability AS DOUBLE) AS v, sum(TARGET) AS pos, count(*) - sum(TARGET) AS neg
  FROM test WHERE probability IS NOT NULL AND TARGET IS NOT NULL GROUP BY 1),
cum AS (SELECT v, sum(pos) OVER (ORDER BY v DESC) AS tp, sum(neg) OVER (ORDER BY v DESC) AS fp,
               sum(pos) OVER () AS P FROM thr)
SELECT round(v, {D}) AS threshold, round(tp / (tp + fp), {D}) AS precision, round(tp / P, {D}) AS recall FROM cum
UNION ALL SELECT NULL, 1e0, 0e0""",
        "numeric_params": _numeric_params(),
        "onehot_levels": SPLIT + """SELECT 'c_mktsegment' AS column_name, v AS category,
  CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS position
FROM (SELECT DISTINCT coalesce(c_mktsegment, 'missing') AS v FROM split WHERE split = 'train')""",
        "target_encoding": _target_encoding(),
        "encoded_features": encoded_features_sql(SEGMENTS),
        "applicant_cards": _cards(),
        "first_ids": SCORES + "SELECT SK_ID_CURR FROM test ORDER BY SK_ID_CURR LIMIT 10",
        "explain_sample": SCORES + "SELECT SK_ID_CURR, TARGET FROM test "
                                   "ORDER BY md5('43|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR LIMIT 5000",
        "sample_membership": SCORES + """, smp AS (SELECT SK_ID_CURR FROM test
  ORDER BY md5('43|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR LIMIT 5000)
SELECT s.SK_ID_CURR, smp.SK_ID_CURR IS NOT NULL AS explained
FROM scores s LEFT JOIN smp ON s.SK_ID_CURR = smp.SK_ID_CURR""",
    }
