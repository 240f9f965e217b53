"""DuckDB SQL twins of the registered queries (independent formulations of the same results).

Built as strings from small helpers so the window-feature and profile SQL follows the same
column lists as the Spark side. Floating outputs are rounded to 6 digits (and -0.0 folded into
0.0) on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..sources.fixtures import PANEL_SQL, SCORED_SQL, SITE_SQL

KEYS = ("LAT", "LON")
FEAT = ("precip", "n_obs", "humid")
LAGS = (1, 2, 3)
WINDOWS = (3, 6)
PAST = (3, 6)
# past rolls built by the feature chain: only K whose lags 1..K were all requested
CHAIN_PAST = tuple(k for k in PAST if all(i in LAGS for i in range(1, k + 1)))


def rounded(inner: str, doubles: Sequence[str]) -> str:
    if not doubles:
        return inner
    rep = ", ".join(f"round({c}, 6) + CAST(0.0 AS DOUBLE) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) _q"


def keys_ok(keys=KEYS) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


def part(keys=KEYS) -> str:
    return ", ".join(keys)


def z_exprs(cols=FEAT, keys=KEYS) -> list[str]:
    out = []
    for c in cols:
        g = f"OVER (PARTITION BY {part(keys)})"
        sd = f"stddev_pop({c}) {g}"
        out.append(f"CASE WHEN {keys_ok(keys)} THEN (CASE WHEN {sd} IS NULL OR {sd} = 0 THEN CAST(0.0 AS DOUBLE) "
                   f"ELSE ({c} - avg({c}) {g}) / {sd} END) END AS {c}__z")
    return out


def lag_exprs(cols=FEAT, keys=KEYS, order="date", lags=LAGS) -> list[str]:
    return [f"CASE WHEN {keys_ok(keys)} THEN lag({c}, {k}) OVER (PARTITION BY {part(keys)} ORDER BY {order}) END "
            f"AS {c}__lag{k}" for k in lags for c in cols]


def roll_exprs(cols=FEAT, keys=KEYS, order="date", windows=WINDOWS) -> list[str]:
    out = []
    for w in windows:
        fr = f"OVER (PARTITION BY {part(keys)} ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        for c in cols:
            out.append(f"CASE WHEN {keys_ok(keys)} AND count({c}) {fr} = {w} THEN avg({c}) {fr} END AS {c}__roll{w}m")
    return out


def past_exprs(cols=FEAT, keys=KEYS, order="date", ks=PAST) -> list[str]:
    out = []
    for k in ks:
        fr = f"OVER (PARTITION BY {part(keys)} ORDER BY {order} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        for c in cols:
            out.append(f"CASE WHEN {keys_ok(keys)} THEN avg({c}) {fr} END AS {c}__roll_prev{k}m")
    return out


def block_expr(km: float = 50.0, lat="LAT", lon="LON") -> str:
    dlat = f"(CAST({km!r} AS DOUBLE) / CAST(111.32 AS DOUBLE))"
    dlon = (f"(CAST({km!r} AS DOUBLE) / (CAST(111.32 AS DOUBLE) * greatest(CAST(1e-6 AS DOUBLE), "
            f"cos(radians({lat})))))")
    return (f"CAST(CAST(floor(({lat} + 90.0) / {dlat}) AS BIGINT) AS VARCHAR) || '_' || "
            f"CAST(CAST(floor(({lon} + 180.0) / {dlon}) AS BIGINT) AS VARCHAR)")


# ---- building blocks as CTE text

MERGED_SQL = f"""
SELECT p.loc_id, p.LAT, p.LON, p.YEAR, p.MONTH, p.precip, p.n_obs, p.humid, s.elev, s.soil_class
FROM ({PANEL_SQL}) p LEFT JOIN ({SITE_SQL}) s ON p.loc_id IS NOT DISTINCT FROM s.loc_id
"""

DATED_SQL = f"SELECT *, make_date(YEAR, MONTH, 1) AS date FROM ({MERGED_SQL}) m"

BLOCKED_SQL = f"SELECT *, {block_expr(50.0)} AS block_id FROM ({DATED_SQL}) d"

FEATURED_SQL = (f"SELECT *, {', '.join(z_exprs() + lag_exprs() + roll_exprs() + past_exprs(ks=CHAIN_PAST))} "
                f"FROM ({BLOCKED_SQL}) b")

LABELLED_SQL = f"""
SELECT f.*, c.ppt_pctl, COALESCE(CAST(f.precip <= c.ppt_pctl AS BIGINT), CAST(0 AS BIGINT)) AS sequia
FROM ({FEATURED_SQL}) f
LEFT JOIN (SELECT LAT, LON, MONTH, quantile_cont(precip, 0.2) AS ppt_pctl
           FROM ({FEATURED_SQL}) ff GROUP BY LAT, LON, MONTH) c
  ON f.LAT IS NOT DISTINCT FROM c.LAT AND f.LON IS NOT DISTINCT FROM c.LON AND f.MONTH IS NOT DISTINCT FROM c.MONTH
"""


def labelled_columns() -> list[tuple[str, str]]:
    """(name, spark simple type) of the labelled panel, in order."""
    cols = [("loc_id", "bigint"), ("LAT", "double"), ("LON", "double"), ("YEAR", "bigint"), ("MONTH", "bigint"),
            ("precip", "double"), ("n_obs", "bigint"), ("humid", "double"), ("elev", "double"),
            ("soil_class", "bigint"), ("date", "date"), ("block_id", "string")]
    cols += [(f"{c}__z", "double") for c in FEAT]
    cols += [(f"{c}__lag{k}", "bigint" if c == "n_obs" else "double") for k in LAGS for c in FEAT]
    cols += [(f"{c}__roll{w}m", "double") for w in WINDOWS for c in FEAT]
    cols += [(f"{c}__roll_prev{k}m", "double") for k in CHAIN_PAST for c in FEAT]
    cols += [("ppt_pctl", "double"), ("sequia", "bigint")]
    return cols


def doubles_of(cols: Sequence[tuple[str, str]]) -> list[str]:
    return [c for c, t in cols if t == "double"]


EDA_EXCLUDE = {"sequia", "block_id", "LAT", "LON", "YEAR", "MONTH", "date"}


def eda_numeric() -> list[str]:
    return [c for c, t in labelled_columns() if t in ("bigint", "double") and c not in EDA_EXCLUDE]


def schema_profile_sql() -> str:
    cols = labelled_columns()
    sel = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS n_{i}" for i, (c, _) in enumerate(cols))
    rows = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, n_{i} AS na_frac FROM one"
                              for i, (c, t) in enumerate(cols))
    return rounded(f"WITH one AS (SELECT {sel} FROM ({LABELLED_SQL}) l) {rows}", ["na_frac"])


def missingness_sql() -> str:
    cols = labelled_columns()
    sel = ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS n_{i}" for i, (c, _) in enumerate(cols))
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, n_{i} AS na_frac FROM one" for i, (c, _) in enumerate(cols))
    return rounded(f"WITH one AS (SELECT {sel} FROM ({LABELLED_SQL}) l) {rows}", ["na_frac"])


def missing_avg_sql() -> str:
    cols = labelled_columns()
    terms = " + ".join(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE" for c, _ in cols)
    inner = (f"SELECT count(*) AS n_rows, CAST({len(cols)} AS BIGINT) AS n_cols, "
             f"({terms}) / {float(len(cols))!r} AS avg_na_frac FROM ({LABELLED_SQL}) l")
    return rounded(inner, ["avg_na_frac"])


def _corr_sql(x: str, y: str) -> str:
    xp = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    yp = f"CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    den = f"(stddev_pop({xp}) * stddev_pop({yp}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE covar_pop({xp}, {yp}) / {den} END"


def target_corr_inner() -> str:
    feats = eda_numeric()
    sel = ", ".join(f"count({c}) AS k_{i}, {_corr_sql(c, 'sequia')} AS r_{i}" for i, c in enumerate(feats))
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, CASE WHEN k_{i} >= 3 THEN r_{i} END AS corr_target FROM one"
                              for i, c in enumerate(feats))
    return f"WITH one AS (SELECT {sel} FROM ({LABELLED_SQL}) l) {rows}"


def target_corr_sql() -> str:
    return rounded(target_corr_inner(), ["corr_target"])


def topk_corr_sql(k: int = 30) -> str:
    inner = (f"SELECT * FROM ({target_corr_inner()}) t "
             f"ORDER BY abs(corr_target) DESC NULLS LAST, feature LIMIT {k}")
    return rounded(inner, ["corr_target"])


HIST_COLS = ("precip", "n_obs", "humid")


def histogram_sql(cols=HIST_COLS, bins: int = 40) -> str:
    unions = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM ({LABELLED_SQL}) l{i}"
                                for i, c in enumerate(cols))
    nb = bins
    edge = lambda i: f"(CASE WHEN {i} >= {nb} THEN hi ELSE CAST({i} AS DOUBLE) * ((hi - lo) / {float(nb)!r}) + lo END)"
    inner = f"""
WITH long AS (SELECT * FROM ({unions}) u WHERE v IS NOT NULL),
mm AS (SELECT feature, min(v) AS mn, max(v) AS mx FROM long GROUP BY feature),
rng AS (SELECT feature, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
               CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM mm),
b0 AS (SELECT l.feature, l.v, r.lo, r.hi,
              least(CAST(floor((l.v - r.lo) * ({float(nb)!r} / (r.hi - r.lo))) AS INTEGER), {nb - 1}) AS i0
       FROM long l JOIN rng r USING (feature)),
b1 AS (SELECT feature, v, lo, hi, CASE WHEN v < {edge('i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM b0),
b2 AS (SELECT feature, CASE WHEN i1 <> {nb - 1} AND v >= {edge('(i1 + 1)')} THEN i1 + 1 ELSE i1 END AS bin FROM b1),
cnt AS (SELECT feature, bin, count(*) AS n FROM b2 GROUP BY feature, bin),
grid AS (SELECT feature, lo, hi, CAST(g.bin AS INTEGER) AS bin FROM rng, range(0, {nb}) g(bin))
SELECT g.feature, g.bin, {edge('g.bin')} AS bin_lo, {edge('(g.bin + 1)')} AS bin_hi,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin
"""
    return rounded(inner, ["bin_lo", "bin_hi"])


def corr_matrix_sql(k: int = 30) -> str:
    """Top-k features by |r| with the target; median impute; Pearson of every pair."""
    topk = f"SELECT feature FROM ({target_corr_inner()}) t ORDER BY abs(corr_target) DESC NULLS LAST, feature LIMIT {k}"
    feats = eda_numeric()
    # The matrix needs static column references: compute every numeric pair, keep the top-k ones.
    med = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{i}" for i, c in enumerate(feats))
    imp = ", ".join(f"COALESCE(CAST(l.{c} AS DOUBLE), md.m_{i}) AS x_{i}" for i, c in enumerate(feats))
    pairs = []
    for i, a in enumerate(feats):
        for j, b in enumerate(feats):
            lo, hi = min(i, j), max(i, j)
            pairs.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, c_{lo}_{hi} AS r FROM mom")
    moms = []
    for i in range(len(feats)):
        for j in range(i, len(feats)):
            den = f"(stddev_pop(x_{i}) * stddev_pop(x_{j}))"
            moms.append(f"CASE WHEN {den} = 0 THEN NULL ELSE covar_pop(x_{i}, x_{j}) / {den} END AS c_{i}_{j}")
    inner = f"""
WITH lab AS ({LABELLED_SQL}),
md AS (SELECT {med} FROM lab),
imp AS (SELECT {imp} FROM lab l, md),
mom AS (SELECT {', '.join(moms)} FROM imp),
allp AS ({' UNION ALL '.join(pairs)}),
top AS ({topk})
SELECT a.* FROM allp a WHERE a.feature_a IN (SELECT feature FROM top) AND a.feature_b IN (SELECT feature FROM top)
"""
    return rounded(inner, ["r"])


DATED_PANEL_SQL = f"SELECT *, make_date(YEAR, MONTH, 1) AS date FROM ({PANEL_SQL}) p"
PANEL_D = ["LAT", "LON", "precip", "humid"]
LAB_D = doubles_of(labelled_columns())


def _feat_doubles(suffixes: Sequence[str]) -> list[str]:
    return [f"{c}{s}" for s in suffixes for c in FEAT if not (c == "n_obs" and "__lag" in s)]


ORACLE: dict[str, str] = {
    "read_panel": rounded(PANEL_SQL, PANEL_D),
    "enrich_left_join": rounded(MERGED_SQL, PANEL_D + ["elev"]),
    "month_start_date": rounded(DATED_PANEL_SQL, PANEL_D),
    "parse_date_strict": rounded(
        f"SELECT * REPLACE (CAST(strptime(strftime(date, '%Y-%m-%d'), '%Y-%m-%d') AS TIMESTAMP) AS date) "
        f"FROM ({DATED_PANEL_SQL}) d", PANEL_D),
    "spatial_block": rounded(
        f"SELECT loc_id, LAT, LON, YEAR, MONTH, {block_expr(50.0)} AS block_id, {block_expr(100.0)} AS block_id_100 "
        f"FROM ({PANEL_SQL}) p", ["LAT", "LON"]),
    "zscore_by_group": rounded(f"SELECT *, {', '.join(z_exprs())} FROM ({PANEL_SQL}) p",
                               PANEL_D + _feat_doubles(["__z"])),
    "lag_features": rounded(f"SELECT *, {', '.join(lag_exprs())} FROM ({DATED_PANEL_SQL}) d",
                            PANEL_D + _feat_doubles([f"__lag{k}" for k in LAGS])),
    "rolling_mean": rounded(f"SELECT *, {', '.join(roll_exprs())} FROM ({DATED_PANEL_SQL}) d",
                            PANEL_D + _feat_doubles([f"__roll{w}m" for w in WINDOWS])),
    "rolling_mean_past": rounded(f"SELECT *, {', '.join(past_exprs())} FROM ({DATED_PANEL_SQL}) d",
                                 PANEL_D + _feat_doubles([f"__roll_prev{k}m" for k in PAST])),
    "add_features": rounded(FEATURED_SQL, [c for c in LAB_D if c != "ppt_pctl"]),
    "add_features_skew_safe": rounded(FEATURED_SQL, [c for c in LAB_D if c != "ppt_pctl"]),
    "climatology_percentile": rounded(
        f"SELECT LAT, LON, MONTH, quantile_cont(precip, 0.2) AS ppt_pctl "
        f"FROM ({PANEL_SQL}) p GROUP BY LAT, LON, MONTH", ["LAT", "LON", "ppt_pctl"]),
    "event_label": rounded(LABELLED_SQL, LAB_D),
    "write_panel": rounded(LABELLED_SQL, LAB_D),
    "drop_leakage": rounded(
        f"SELECT * EXCLUDE (precip, precip__z, precip__roll3m, precip__roll6m, ppt_pctl) FROM ({LABELLED_SQL}) l",
        [c for c in LAB_D if c not in ("precip", "precip__z", "precip__roll3m", "precip__roll6m", "ppt_pctl")]),
    "target_balance": rounded(
        f"SELECT sequia, count(*) AS count, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS ratio "
        f"FROM ({LABELLED_SQL}) l GROUP BY sequia", ["ratio"]),
    "label_prevalence": rounded(
        f"SELECT CAST(sum(sequia) AS BIGINT) AS positives, count(*) AS n, avg(CAST(sequia AS DOUBLE)) AS prevalence "
        f"FROM ({LABELLED_SQL}) l", ["prevalence"]),
    "schema_profile": schema_profile_sql(),
    "missingness_profile": missingness_sql(),
    "missing_fraction_avg": missing_avg_sql(),
    "target_correlation": target_corr_sql(),
    "topk_by_abs_corr": topk_corr_sql(30),
    "correlation_matrix_topk": corr_matrix_sql(30),
    "column_histogram": histogram_sql(),
}


# ---- scored-table oracles (metrics, folds, sampling)

def _h(col: str, seed: int = 42) -> str:
    return f"md5(CAST({col} AS VARCHAR) || ':{seed}')"


def group_folds_sql(k: int = 5) -> str:
    """Each group, largest first and groups of one size in hash order, goes to the lightest fold (of equal ones the first)."""
    return f"""
WITH RECURSIVE g AS (
  SELECT grp, n, row_number() OVER (ORDER BY n DESC, {_h('grp')} NULLS FIRST, grp NULLS FIRST) AS r
  FROM (SELECT grp, count(*) AS n FROM ({SCORED_SQL}) s GROUP BY grp) c
), deal AS (
  SELECT CAST(0 AS BIGINT) AS r, CAST(NULL AS BIGINT) AS grp, CAST(0 AS BIGINT) AS n, CAST(0 AS INTEGER) AS fold, list_transform(range({k}), lambda x: CAST(0 AS BIGINT)) AS loads
  UNION ALL
  SELECT g.r, g.grp, g.n, CAST(list_position(loads, list_min(loads)) - 1 AS INTEGER),
         list_transform(loads, lambda x, i: x + CASE WHEN i = list_position(loads, list_min(loads)) THEN g.n ELSE 0 END)
  FROM deal JOIN g ON g.r = deal.r + 1
)
SELECT grp, n, fold FROM deal WHERE r > 0
"""


SCORED_FOLDS_SQL = f"SELECT s.*, f.fold FROM ({SCORED_SQL}) s LEFT JOIN ({group_folds_sql()}) f ON s.grp IS NOT DISTINCT FROM f.grp"


def cum_sql(src: str, by: Sequence[str] = ()) -> str:
    b = ", ".join(by)
    bsel = f"{b}, " if by else ""
    pb = f"PARTITION BY {b} " if by else ""
    fr = f"OVER ({pb}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""
SELECT {bsel}score, tp, fp, CAST(sum(tp) {fr} AS BIGINT) AS cum_tp, CAST(sum(fp) {fr} AS BIGINT) AS cum_fp
FROM (SELECT {bsel}prob AS score, CAST(sum(y) AS BIGINT) AS tp, CAST(count(*) - sum(y) AS BIGINT) AS fp
      FROM ({src}) s GROUP BY {bsel}prob) t
"""


def ranking_sql(src: str, by: Sequence[str] = ()) -> str:
    b = ", ".join(by)
    bsel = f"{b}, " if by else ""
    grp = f" GROUP BY {b}" if by else ""
    return f"""
SELECT {bsel}
  sum(CAST(tp AS DOUBLE) * cum_tp / (cum_tp + cum_fp)) / sum(tp) AS pr_auc,
  CAST(sum(fp * (2 * cum_tp - tp)) AS DOUBLE) / (2.0 * sum(tp) * sum(fp)) AS roc_auc
FROM ({cum_sql(src, by)}) c{grp}
"""


def confusion_sql(src: str, th: float = 0.5) -> str:
    t = f"CAST({th!r} AS DOUBLE)"
    return f"""
SELECT {t} AS threshold, tp, fp, tn, fn, n,
       CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
       positive_rate_pred, positive_rate_true, brier
FROM (SELECT CAST(sum(CASE WHEN prob >= {t} AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN prob >= {t} AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN prob < {t} AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(sum(CASE WHEN prob < {t} AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             count(*) AS n,
             avg(CASE WHEN prob >= {t} THEN 1.0 ELSE 0.0 END)::DOUBLE AS positive_rate_pred,
             avg(CAST(y AS DOUBLE)) AS positive_rate_true,
             avg(pow(prob - y, 2)) AS brier
      FROM ({src}) s) a
"""


def sweep_sql(src: str, objective: str = "f1", lo: int = 5, hi: int = 95) -> str:
    obj = {"f1": "f1", "recall": "recall", "precision": "precision", "youden": "recall - fpr",
           "cost": "CAST(0.7 AS DOUBLE) * recall + CAST(0.3 AS DOUBLE) * precision"}[objective]
    return f"""
SELECT *, {obj} AS objective FROM (
  SELECT fold, threshold, tp, fp, tn, fn,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1,
         CASE WHEN fp + tn = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / (fp + tn) END AS fpr
  FROM (SELECT s.fold, CAST(g.k AS DOUBLE) / CAST(100.0 AS DOUBLE) AS threshold,
               CAST(sum(CASE WHEN s.prob >= CAST(g.k AS DOUBLE) / CAST(100.0 AS DOUBLE) AND s.y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
               CAST(sum(CASE WHEN s.prob >= CAST(g.k AS DOUBLE) / CAST(100.0 AS DOUBLE) AND s.y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
               CAST(sum(CASE WHEN s.prob < CAST(g.k AS DOUBLE) / CAST(100.0 AS DOUBLE) AND s.y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
               CAST(sum(CASE WHEN s.prob < CAST(g.k AS DOUBLE) / CAST(100.0 AS DOUBLE) AND s.y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
        FROM ({src}) s, range({lo}, {hi + 1}) g(k)
        GROUP BY s.fold, g.k) c) d
"""


def by_fold_sql(src: str, objective: str = "f1") -> str:
    return f"""
SELECT b.fold, b.threshold AS best_threshold, r.pr_auc, r.roc_auc, b.f1, b.recall, b.precision,
       b.tp, b.fp, b.tn, b.fn
FROM (SELECT * FROM ({sweep_sql(src, objective)}) w
      QUALIFY row_number() OVER (PARTITION BY fold ORDER BY objective DESC, threshold ASC) = 1) b
JOIN ({ranking_sql(src, ['fold'])}) r ON b.fold = r.fold
"""


def cv_summary_sql(src: str, metrics: Sequence[str]) -> str:
    unions = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM per_fold" for m in metrics)
    return (f"WITH per_fold AS ({by_fold_sql(src)}) SELECT metric, avg(v) AS mean, stddev_pop(v) AS std "
            f"FROM ({unions}) u GROUP BY metric")


_CM = ["precision", "recall", "f1", "positive_rate_pred", "positive_rate_true", "brier", "threshold"]
_SWEEP_D = ["threshold", "precision", "recall", "f1", "fpr", "objective"]
_FOLD_D = ["best_threshold", "pr_auc", "roc_auc", "f1", "recall", "precision"]

ORACLE.update({
    "threshold_predict": rounded(f"SELECT *, CAST(prob >= CAST(0.5 AS DOUBLE) AS INTEGER) AS pred FROM ({SCORED_SQL}) s",
                                 ["prob"]),
    "average_precision": rounded(f"SELECT pr_auc FROM ({ranking_sql(SCORED_SQL)}) r", ["pr_auc"]),
    "roc_auc": rounded(f"SELECT roc_auc FROM ({ranking_sql(SCORED_SQL)}) r", ["roc_auc"]),
    "confusion_metrics": rounded(confusion_sql(SCORED_SQL), _CM),
    "brier_score": rounded(f"SELECT avg(pow(prob - y, 2)) AS brier FROM ({SCORED_SQL}) s", ["brier"]),
    "cumulative_counts": rounded(cum_sql(SCORED_SQL), ["score"]),
    "fold_ranking_metrics": rounded(ranking_sql(SCORED_FOLDS_SQL, ["fold"]), ["pr_auc", "roc_auc"]),
    "write_metrics": rounded(
        f"SELECT c.threshold, r.pr_auc, r.roc_auc, c.f1, c.recall, c.precision, c.brier, c.tp, c.fp, c.tn, c.fn, c.n, "
        f"c.positive_rate_pred, c.positive_rate_true FROM ({confusion_sql(SCORED_SQL)}) c, ({ranking_sql(SCORED_SQL)}) r",
        _CM + ["pr_auc", "roc_auc"]),
    "pr_curve": rounded(f"""
        WITH c AS ({cum_sql(SCORED_SQL)}), t AS (SELECT sum(tp) AS P FROM c)
        SELECT score AS threshold,
               CASE WHEN cum_tp + cum_fp = 0 THEN 0.0 ELSE CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) END AS precision,
               CASE WHEN P = 0 THEN 1.0 ELSE CAST(cum_tp AS DOUBLE) / P END AS recall FROM c, t
        UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0""", ["threshold", "precision", "recall"]),
    "roc_curve": rounded(f"""
        WITH c AS ({cum_sql(SCORED_SQL)}), t AS (SELECT sum(tp) AS P, sum(fp) AS N FROM c)
        SELECT score AS threshold, CAST(cum_fp AS DOUBLE) / N AS fpr, CAST(cum_tp AS DOUBLE) / P AS tpr FROM c, t
        UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0, 0.0""", ["threshold", "fpr", "tpr"]),
    "reliability_curve": rounded(f"""
        SELECT CAST({' + '.join(f'(CASE WHEN prob > CAST({i * (1.0 / 10)!r} AS DOUBLE) THEN 1 ELSE 0 END)'
                                 for i in range(1, 10))} AS INTEGER) AS bin,
               avg(CAST(y AS DOUBLE)) AS prob_true, avg(prob) AS prob_pred, count(*) AS count
        FROM ({SCORED_SQL}) s GROUP BY 1""", ["prob_true", "prob_pred"]),
    "threshold_sweep": rounded(sweep_sql(SCORED_FOLDS_SQL, "f1"), _SWEEP_D),
    "threshold_by_fold": rounded(by_fold_sql(SCORED_FOLDS_SQL, "f1"), _FOLD_D),
    "threshold_by_fold_youden": rounded(by_fold_sql(SCORED_FOLDS_SQL, "youden"), _FOLD_D),
    "threshold_by_fold_cost": rounded(by_fold_sql(SCORED_FOLDS_SQL, "cost"), _FOLD_D),
    "cv_summary": rounded(cv_summary_sql(SCORED_FOLDS_SQL, _FOLD_D), ["mean", "std"]),
    "group_kfold": group_folds_sql(5),
    "stratified_kfold": f"""SELECT row_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {_h('row_id')}, row_id) - 1) % 5
                              AS INTEGER) AS fold FROM ({SCORED_SQL}) s""",
    "shuffled_kfold": f"""SELECT row_id, CAST((row_number() OVER (ORDER BY {_h('row_id')}, row_id) - 1) % 5 AS INTEGER)
                            AS fold FROM ({SCORED_SQL}) s""",
    "sample_groups": rounded(f"""
        WITH s AS ({SCORED_SQL}), g AS (SELECT DISTINCT grp FROM s WHERE grp IS NOT NULL),
             r AS (SELECT grp, row_number() OVER (ORDER BY {_h('grp')}, grp) - 1 AS rk FROM g),
             n AS (SELECT count(*) AS c FROM g)
        SELECT s.* FROM s WHERE s.grp IN (
            SELECT grp FROM r, n WHERE rk < greatest(1, CAST(floor(c * CAST(0.35 AS DOUBLE)) AS BIGINT)))""", ["prob"]),
    "sample_stratified": rounded(f"""
        WITH s AS ({SCORED_SQL}),
             r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_h('row_id')}, row_id) - 1 AS rk,
                          count(*) OVER (PARTITION BY y) AS nc FROM s)
        SELECT row_id, grp, y, prob FROM r WHERE rk < CAST(round(nc * CAST(0.35 AS DOUBLE)) AS BIGINT)""", ["prob"]),
    "group_semi_join": rounded(f"SELECT * FROM ({PANEL_SQL}) p WHERE loc_id IN (SELECT loc_id FROM ({SITE_SQL}) s WHERE elev IS NOT NULL)",
                               PANEL_D),
})


# ---- preprocessing oracles (model inputs)

MODEL_SQL = f"SELECT *, loc_id * 1000000 + YEAR * 100 + MONTH AS row_id FROM ({LABELLED_SQL}) l"
PREP_COLS = ("humid", "elev", "precip__lag1", "n_obs__lag3", "humid__roll3m", "precip__roll_prev3m")


def _imputed(c: str) -> str:
    return f"COALESCE(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER ())"


ORACLE.update({
    "impute_median": rounded(f"SELECT row_id, {', '.join(f'{_imputed(c)} AS {c}' for c in PREP_COLS)} "
                             f"FROM ({MODEL_SQL}) m", list(PREP_COLS)),
    "standardize": rounded(
        f"SELECT row_id, {', '.join(f'CASE WHEN stddev_pop(i_{c}) OVER () > 0 THEN (i_{c} - avg(i_{c}) OVER ()) / stddev_pop(i_{c}) OVER () ELSE 0.0 END AS {c}' for c in PREP_COLS)} "
        f"FROM (SELECT row_id, {', '.join(f'{_imputed(c)} AS i_{c}' for c in PREP_COLS)} FROM ({MODEL_SQL}) m) t",
        list(PREP_COLS)),
    "balanced_class_weight": rounded(
        f"SELECT sequia, row_id, CAST(count(*) OVER () AS DOUBLE) / (2.0 * count(*) OVER (PARTITION BY sequia)) AS weight "
        f"FROM ({MODEL_SQL}) m", ["weight"]),
    "smote_oversample": f"""
        WITH c AS (SELECT sequia, count(*) AS n FROM ({LABELLED_SQL}) l GROUP BY sequia),
             mn AS (SELECT sequia FROM c ORDER BY n, sequia LIMIT 1)
        SELECT sequia, false AS _synthetic, n FROM c
        UNION ALL
        SELECT (SELECT sequia FROM mn), true, (SELECT max(n) - min(n) FROM c)""",
})


# ---- train statistics of each fold, isotonic values of given scores, chosen columns




def fold_statistics_sql() -> str:
    parts = []
    for c in PREP_COLS:
        med = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM m WHERE fold <> f.fold)"
        filled = f"coalesce(CAST({c} AS DOUBLE), {med})"
        parts.append(f"SELECT CAST(f.fold AS INTEGER) AS fold, '{c}' AS feature, {med} AS median, (SELECT avg({filled}) FROM m WHERE fold <> f.fold) AS mean, "
                     f"(SELECT stddev_pop({filled}) FROM m WHERE fold <> f.fold) AS deviation FROM folds f")
    inner = f"WITH m AS (SELECT *, YEAR % 5 AS fold FROM ({LABELLED_SQL}) l), folds AS (SELECT unnest(range(5)) AS fold) " + " UNION ALL ".join(parts)
    return rounded(inner, ["median", "mean", "deviation"])


#: The largest, over starts up to a score, of the smallest mean from there over ends from the score on.
ISOTONIC_SQL = f"""
WITH d AS (SELECT prob AS s, sum(y) AS t, count(*) AS w FROM ({SCORED_SQL}) x GROUP BY prob),
c AS (SELECT s, row_number() OVER (ORDER BY s) AS i, sum(t) OVER (ORDER BY s) AS st, sum(w) OVER (ORDER BY s) AS sw, t, w FROM d),
ends AS (SELECT a.i AS a, b.i AS b, (b.st - a.st + a.t)::DOUBLE / (b.sw - a.sw + a.w)::DOUBLE AS m FROM c a JOIN c b ON b.i >= a.i),
low AS (SELECT a, b, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM ends),
iso AS (SELECT b AS i, max(m) AS v FROM low GROUP BY b)
SELECT s, v AS calibrated FROM iso JOIN c USING (i)
"""

ORACLE |= {
    "fold_statistics": fold_statistics_sql(),
    "isotonic_scores": rounded(ISOTONIC_SQL, ["s", "calibrated"]),
    "select_columns": rounded(f"SELECT precip__lag1, n_obs, humid__roll3m, sequia, block_id, LAT, LON, date FROM ({LABELLED_SQL}) l", ["precip__lag1", "humid__roll3m", "LAT", "LON"]),
}
