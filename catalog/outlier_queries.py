"""Queries for the statistical filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import audit_sql as A
from catalog import fixtures as X
from catalog.ordered_queries import _ffill, slim
from catalog.registry import cte, query, snap, snap_sql
from panelmend import schema as S
from panelmend.functions.quantiles import normal_two_sided
from panelmend.operators import garch, mad, rolling_z, sector_outliers, spline
from panelmend.operators.outlier_audit import worst_points
from panelmend.operators.sector_model import ledoit_wolf, robust_models
from panelmend.workspace import Workspace

LIMIT = normal_two_sided(0.0001)
MODEL = ["fbs_assets", "fbs_current_assets", "fis_revenues", S.BASIC_SHARES]


def _sure(flag):
    """A value that cannot be judged is no outlier."""
    return F.coalesce(flag, F.lit(False))


# -- rolling z --------------------------------------------------------------------------------------
def _z_sql(source: str, columns: list[str]) -> str:
    w = "over (partition by ticker order by seq rows between 21 preceding and 1 preceding)"
    stats = ", ".join(f"avg({c}) {w} as mu{i}, stddev_samp({c}) {w} as sd{i}, count({c}) {w} as n{i}"
                      for i, c in enumerate(columns))
    zs = ", ".join(f"case when n{i} >= 10 and sd{i} > 0 then ({c} - mu{i}) / sd{i} end as z{i}"
                   for i, c in enumerate(columns))
    return f"scored as (select *, {zs} from (select *, {stats} from {source}))"


@query("E1_rolling_z_detect", cte(X.SERIES, _z_sql("series", ["v"])) + f"""
select ticker, seq, v, {snap_sql('z0', 4)} as z, coalesce(abs(z0) > {LIMIT!r}, false) as outlier from scored""")
def z_detect(spark, sf):
    df, layout = X.series(spark, sf)
    out = rolling_z.with_z(df, layout, ["v"])
    return out.select("ticker", "seq", "v", snap(F.col("_z_v"), 4).alias("z"),
                      _sure(rolling_z.z_flags(["v"])["v"]).alias("outlier"))


@query("E1_rolling_z_detect_bars", cte(X.BARS, _z_sql("bars", ["m_close", "m_vwap", "m_high"])) + f"""
select ticker, seq, coalesce(abs(z0) > {LIMIT!r}, false) as m_close,
  coalesce(abs(z1) > {LIMIT!r}, false) as m_vwap, coalesce(abs(z2) > {LIMIT!r}, false) as m_high
from scored""")
def z_detect_bars(spark, sf):
    df, layout = X.bars(spark, sf)
    cols = ["m_close", "m_vwap", "m_high"]
    out = rolling_z.with_z(df, layout, cols)
    return out.select("ticker", "seq", *[_sure(e).alias(c) for c, e in rolling_z.z_flags(cols).items()])


def _spline_sql(points: str) -> str:
    """CTEs up to ``fixed (ticker, col, seq, v, corrected)`` from ``points``, a query of
    (ticker, col, seq, v, hit): the whole system of each series by elimination, a step per recursion."""
    return f"""pts as materialized (
  select * from ({points}) qualify bool_or(hit) over (partition by ticker, col)),
clean as (
  select ticker, col, seq::double x, v y, count(*) over s cnt, row_number() over (s order by seq) n
  from pts where not hit and v is not null window s as (partition by ticker, col)),
steps as (
  select *, lead(x) over w - x h, (lead(y) over w - y) / (lead(x) over w - x) m
  from clean where cnt >= 4 window w as (partition by ticker, col order by n)),
sides as (
  select *, lag(h) over w hp, lag(m) over w mp, lag(h, 2) over w hq, lag(m, 2) over w mq,
         lead(h) over w hn, lead(m) over w mn
  from steps window w as (partition by ticker, col order by n)),
eqs as materialized (
  select *, lag(up) over (partition by ticker, col order by n) up0 from (
    select ticker, col, n, cnt, x, y, h, m,
      case when n = 1 then 0 when n = cnt then hp + hq else h end lo,
      case when n = 1 then hn when n = cnt then hq else 2 * (hp + h) end di,
      case when n = 1 then h + hn when n = cnt then 0 else hp end up,
      case when n = 1 then ((h + 2 * (h + hn)) * hn * m + h * h * mn) / (h + hn)
           when n = cnt then ((hp + 2 * (hp + hq)) * hq * mp + hp * hp * mq) / (hp + hq)
           else 3 * (h * mp + hp * m) end rh
    from sides)),
forth as materialized (
  with recursive f as (
    select ticker, col, n, di d, rh r from eqs where n = 1
    union all
    select e.ticker, e.col, e.n, e.di - e.lo / f.d * e.up0, e.rh - e.lo / f.d * f.r
    from f join eqs e on e.ticker = f.ticker and e.col = f.col and e.n = f.n + 1)
  select * from f),
whole as materialized (
  select e.*, d, r from eqs e join forth f on e.ticker = f.ticker and e.col = f.col and e.n = f.n),
back as materialized (
  with recursive b as (
    select ticker, col, n, r / d s from whole where n = cnt
    union all
    select w.ticker, w.col, w.n, (w.r - w.up * b.s) / w.d
    from b join whole w on w.ticker = b.ticker and w.col = b.col and w.n = b.n - 1)
  select * from b),
cubics as (
  select w.ticker, w.col, w.n, w.x, w.y, w.h, w.m, b.s, lead(b.s) over (partition by w.ticker, w.col order by w.n) sn,
         w.cnt
  from whole w join back b on w.ticker = b.ticker and w.col = b.col and w.n = b.n),
placed as (
  select ticker, col, seq, v, hit, sum(case when not hit and v is not null then 1 else 0 end)
    over (partition by ticker, col order by seq) n from pts),
fixed as (
  select p.ticker, p.col, p.seq, p.v,
    y + (p.seq - x) * (s + (p.seq - x) * ((3 * m - 2 * s - sn) / h + (p.seq - x) * ((s + sn - 2 * m) / (h * h)))) corrected
  from (select * from placed where hit) p left join cubics c
    on c.ticker = p.ticker and c.col = p.col and c.n = greatest(1, least(p.n, c.cnt - 1)))"""


def _long_sql(source: str, flags: dict[str, str]) -> str:
    return " union all ".join(
        f"select ticker, '{c}' col, seq, {c} v, {flag} hit from {source}" for c, flag in flags.items())


_Z_HITS = {"m_close": f"coalesce(abs(z0) > {LIMIT!r}, false)", "m_vwap": f"coalesce(abs(z1) > {LIMIT!r}, false)"}
_Z_FIXED = cte(X.BARS, _z_sql("bars", ["m_close", "m_vwap"]), _spline_sql(_long_sql("scored", _Z_HITS)))


@query("E2_spline_repair", _Z_FIXED + f"""
select ticker, seq, col as "column", v, {snap_sql('corrected', 4)} as corrected,
  case when corrected is null then 'too_few_points' else 'cubic_spline' end as method from fixed""")
def spline_repair(spark, sf):
    df, layout = X.bars(spark, sf)
    ws = Workspace(spark)
    panel = ws.table(df.select("ticker", "seq", "m_close", "m_vwap"), "panel")
    hits = ws.table(rolling_z.rolling_z_hits(panel, layout, ["m_close", "m_vwap"]), "hits")
    return spline.spline_repairs(panel, layout, hits, ws, ["m_close", "m_vwap"]).select(
        "ticker", "seq", "column", "v", snap(F.col("corrected"), 4).alias("corrected"), "method")


def _fixed_sql(source: str, columns: list[str], keep: str) -> str:
    """Rows of ``source`` with the columns' corrections in place."""
    joins = " ".join(f"left join fixed f{i} on f{i}.ticker = t.ticker and f{i}.seq = t.seq and f{i}.col = '{c}'"
                     for i, c in enumerate(columns))
    values = ", ".join(f"{snap_sql(f'coalesce(f{i}.corrected, t.{c})', 4)} as {c}" for i, c in enumerate(columns))
    return f"select {keep}, {values} from {source} t {joins}"


@query("E2_rolling_z_filter", _Z_FIXED + _fixed_sql("bars", ["m_close", "m_vwap"], "t.ticker, t.seq, t.m_date"))
def z_filter(spark, sf):
    df, layout = X.bars(spark, sf)
    cols = ["m_close", "m_vwap"]
    ws = Workspace(spark)
    panel = ws.table(df.select("ticker", "seq", "m_date", *cols), "panel")
    out = rolling_z.rolling_z_filter(panel, layout, cols, workspace=ws)
    return out.select("ticker", "seq", "m_date", *[snap(F.col(c), 4).alias(c) for c in cols])


# -- median absolute deviation ----------------------------------------------------------------------
_MAD = ("med as (select *, median(v) over (partition by ticker) as m from series), "
        "dev as (select *, median(abs(v - m)) over (partition by ticker) as d from med), "
        "scored as (select *, case when d <> 0 then (v - m) * 0.6745e0 / d end as z0 from dev)")


@query("E3_mad_detect", cte(X.SERIES, _MAD) + f"""
select ticker, seq, v, {snap_sql('m', 6)} as median, {snap_sql('d', 6)} as mad,
  {snap_sql('z0', 4)} as z, coalesce(abs(z0) > {LIMIT!r}, false) as outlier from scored""")
def mad_detect(spark, sf):
    df, layout = X.series(spark, sf)
    out = mad.with_modified_z(df, layout, ["v"])
    return out.select(
        "ticker", "seq", "v", snap(F.col("_med_v")).alias("median"),
        snap(F.col("_mad_v")).alias("mad"), snap(F.col("_mz_v"), 4).alias("z"),
        _sure(mad.mad_flags(["v"])["v"]).alias("outlier"))


_MAD_HITS = {"v": f"coalesce(abs(z0) > {LIMIT!r}, false)"}
_MAD_FIXED = cte(X.SERIES, _MAD, _spline_sql(_long_sql("scored", _MAD_HITS)))


@query("E3_mad_filter", _MAD_FIXED + _fixed_sql("series", ["v"], "t.ticker, t.seq"))
def mad_filter(spark, sf):
    df, layout = X.series(spark, sf)
    out = mad.mad_filter(df, layout, ["v"], workspace=Workspace(spark))
    return out.select("ticker", "seq", snap(F.col("v"), 4).alias("v"))


@query("E4_mad_skip_info", "with t as (select distinct user_id as ticker from events) " + A.audit_select(
    "mad_filter", "(select ticker, unnest(['c_flat', 'c_empty']) as col from t)",
    error_type="case col when 'c_flat' then 'zero_mad' else 'insufficient_data' end",
    filter_type="'info'", column="col"))
def mad_skipped(spark, sf):
    df, layout = X.series(spark, sf)
    df = df.withColumns({"c_flat": F.lit(1.0), "c_empty": F.lit(None).cast("double")})
    return slim(mad.mad_skipped(df, layout, ["c_flat", "c_empty"]))


# -- GARCH ----------------------------------------------------------------------------------------------
@query("E5_garch_fit")
def garch_fit(spark, sf):
    df, layout = X.bars(spark, sf)
    fits = garch.garch_fits(df, layout, ["m_open"])
    return fits.where("seq is null").select(
        "ticker", "column", "obs", "omega", "alpha", "beta", "nu", "status")


@query("E6_garch_detect")
def garch_detect(spark, sf):
    df, layout = X.bars(spark, sf)
    fits = garch.garch_fits(df, layout, ["m_open"])
    return fits.where("status = 'outlier'").select("ticker", "column", "seq", "residual", "limit")


@query("E6_garch_filter")
def garch_filter(spark, sf):
    df, layout = X.bars(spark, sf)
    ws = Workspace(spark)
    panel = ws.table(df.select("ticker", "seq", "m_date", "m_open"), "panel")
    return garch.garch_filter(panel, layout, ["m_open"], workspace=ws)


@query("E7_garch_skip_info", cte(X.SERIES) + A.audit_select(
    "garch_residuals_filter", "(select ticker, count(v) as n from series group by ticker having count(v) < 100)",
    error_type="'insufficient_data'", filter_type="'info'", column="'v'", count="n"))
def garch_skipped(spark, sf):
    df, layout = X.series(spark, sf)
    return slim(garch.garch_skipped(garch.garch_fits(df, layout, ["v"])))


# -- sectors ----------------------------------------------------------------------------------------------
def universe(spark, sf):
    """Symbols with a sector; every seventh nation has none, even symbols carry a suffix."""
    return X.table(spark, sf, "supplier").selectExpr(
        "concat(cast(s_suppkey as string), case when s_suppkey % 2 = 0 then '.csv' else '' end) symbol",
        "case when s_nationkey % 7 <> 0 then concat('S', cast(s_nationkey % 5 as string)) end sector")


SECTOR_SQL = ("case when s_nationkey % 7 <> 0 then 'S' || (s_nationkey % 5) else 'Unknown' end")


@query("E8_assign_sector", cte(X.BARS) + f"""
select ticker, {SECTOR_SQL} as sector, count(*) as n
from bars join supplier on ticker = s_suppkey group by 1, 2""")
def assign_sector(spark, sf):
    df, _ = X.bars(spark, sf)
    out = sector_outliers.assign_sector(df.select("ticker", "seq"), universe(spark, sf))
    return out.groupBy("ticker", "sector").agg(F.count(F.lit(1)).alias("n"))


def _pooled(spark, sf):
    df, _ = X.panel(spark, sf)
    keyed = sector_outliers.assign_sector(df, universe(spark, sf))
    return sector_outliers.quarter_pool(keyed, MODEL)


POOL = f""",
lastrow as (select *, row_number() over (partition by ticker, quarter_id order by seq desc) as rn_ from panel),
pool0 as (select {SECTOR_SQL} as sector, ticker, quarter_id, m_date, {', '.join(MODEL)}
  from lastrow join supplier on ticker = s_suppkey where rn_ = 1),
pool as (select * from pool0 where sector <> 'Unknown' and sector in
  (select sector from pool0 group by sector having count(distinct ticker) >= 2))"""


@query("E9_sector_quarter_pool", cte(X.PANEL + POOL) + "select * from pool")
def quarter_pool(spark, sf):
    return _pooled(spark, sf)


def _zq_sql() -> str:
    over = "over (partition by sector, quarter_id)"
    med = ", ".join(f"median({c}) {over} as md{i}, avg(abs({c})) {over} as lv{i}" for i, c in enumerate(MODEL))
    dev = ", ".join(f"median(abs({c} - md{i})) {over} * 1.4826e0 as sc{i}" for i, c in enumerate(MODEL))
    z = ", ".join(f"({c} - md{i}) / case when sc{i} < 1e-6 then lv{i} * 0.01e0 + 1e-6 else sc{i} end as z{i}"
                  for i, c in enumerate(MODEL))
    return f""",
peers as (select * from (select *, count(ticker) {over} as np from pool) where np >= 3),
md as (select *, {med} from peers), dv as (select *, {dev} from md), zq as (select *, {z} from dv)"""


@query("E10_robust_quarter_z", cte(X.PANEL + POOL + _zq_sql()) + "select sector, ticker, quarter_id, "
       + ", ".join(f"{snap_sql(f'z{i}', 4)} as z_{c}" for i, c in enumerate(MODEL)) + " from zq")
def quarter_z(spark, sf):
    out = sector_outliers.quarter_z(_pooled(spark, sf), MODEL)
    return out.select("sector", "ticker", "quarter_id", *[
        snap(F.col(f"_z_{c}"), 4).alias(f"z_{c}") for c in MODEL])


def _rows(spark, sf, workspace):
    pool = workspace.table(_pooled(spark, sf), "pool")
    return workspace.table(
        sector_outliers.z_rows(sector_outliers.quarter_z(pool, MODEL), MODEL), "z")


def _models_frame(spark, rows, models):
    """Models as rows (sector, i, j, centre, covariance), keeping only sectors in the data."""
    cells = [(s, i, j, float(m.mean[i]), float(m.covariance[i, j]), m.kind)
             for s, m in models.items() for i in range(len(m.mean)) for j in range(len(m.mean))]
    return spark.createDataFrame(
        cells, "sector string, i int, j int, centre double, covariance double, kind string")


@query("E11_robust_covariance")
def robust_covariance(spark, sf):
    rows = _rows(spark, sf, Workspace(spark))
    return _models_frame(spark, rows, robust_models(rows, len(MODEL)))


def _shrinkage_sql() -> str:
    p = len(MODEL)
    full = " and ".join(f"z{i} is not null" for i in range(p))
    mean = ", ".join(f"avg(z{i}) over (partition by sector) as a{i}" for i in range(p))
    cent = ", ".join(f"z{i} - a{i} as x{i}" for i in range(p))
    norm = " + ".join(f"x{i} * x{i}" for i in range(p))
    cov = " union all ".join(
        f"select sector, {i} as i, {j} as j, avg(x{i} * x{j}) as c from ctr group by sector"
        for i in range(p) for j in range(p))
    means = " union all ".join(
        f"select sector, {i} as i, max(a{i}) as centre from ctr group by sector" for i in range(p))
    return cte(X.PANEL + POOL + _zq_sql() + f""",
ok as (select * from zq where {full}),
ctr as (select *, {cent} from (select *, {mean} from ok)),
cov as ({cov}), means as ({means}),
fourth as (select sector, count(*) as n, sum(({norm}) * ({norm})) as b from ctr group by sector),
tot as (select sector, sum(case when i = j then c end) as tr, sum(c * c) as sq from cov group by sector),
par as (select fourth.sector, tr / {p} as mu, (b / n - sq) / ({p} * n) as beta,
  (sq - 2 * tr / {p} * tr + {p} * (tr / {p}) * (tr / {p})) / {p} as delta
  from fourth join tot on fourth.sector = tot.sector),
shr as (select sector, mu, greatest(0e0, least(beta, delta) / delta) as s from par)
""") + f"""select cov.sector, cov.i, cov.j, {snap_sql('centre', 4)} as centre,
  {snap_sql('(1 - s) * c + case when cov.i = cov.j then s * mu else 0 end', 3)} as covariance, 'shrinkage' as kind
from cov join shr on cov.sector = shr.sector join means on means.sector = cov.sector and means.i = cov.i"""


@query("E12_shrinkage_covariance", _shrinkage_sql())
def shrinkage_covariance(spark, sf):
    rows = _rows(spark, sf, Workspace(spark))
    sectors = [r[0] for r in rows.select("sector").distinct().collect()]
    out = _models_frame(spark, rows, ledoit_wolf(rows, len(MODEL), sectors))
    return out.withColumn("centre", snap(F.col("centre"), 4)).withColumn(
        "covariance", snap(F.col("covariance"), 3))


@query("E13_mahalanobis_detect")
def mahalanobis(spark, sf):
    rows = _rows(spark, sf, Workspace(spark))
    models = robust_models(rows, len(MODEL))
    return sector_outliers.sector_distances(rows, models, len(MODEL)).select(
        "sector", "ticker", "quarter_id", "d2", "limit", (F.col("d2") > F.col("limit")).alias("outlier"))


@query("E13_mahalanobis_filter")
def mahalanobis_filter(spark, sf):
    df, _ = X.panel(spark, sf)
    keyed = sector_outliers.assign_sector(
        df.select("ticker", "seq", "m_date", "quarter_id", *MODEL), universe(spark, sf))
    return sector_outliers.SectorFilter(keyed, Workspace(spark), MODEL).repaired()


_REPAIR_COLS = ["fbs_assets", "c_market_cap"]


def _repair_sql(flatten: bool) -> str:
    new = ", ".join(_ffill(f"case when bad then null else {c} end", f"new_{c}").replace(
        "order by seq", "order by quarter_id") for c in _REPAIR_COLS)
    cond = "tk.ticker is not null" if flatten else "q.bad"
    return cte(X.PANEL + f""",
badq as (select distinct ticker, quarter_id from panel where fis_revenues < 0),
clo as (select p.ticker, p.quarter_id, {', '.join('p.' + c for c in _REPAIR_COLS)}, b.ticker is not null as bad
  from (select *, row_number() over (partition by ticker, quarter_id order by seq desc) as rn_ from panel) p
  left join badq b on b.ticker = p.ticker and b.quarter_id = p.quarter_id where rn_ = 1),
q as (select ticker, quarter_id, bad, {new} from clo)""") + "select p.ticker, p.seq, " + ", ".join(
        f"case when {cond} then coalesce(q.new_{c}, p.{c}) else p.{c} end as {c}" for c in _REPAIR_COLS) + """
from panel p join q on q.ticker = p.ticker and q.quarter_id = p.quarter_id
left join (select distinct ticker from badq) tk on tk.ticker = p.ticker"""


def _repair(spark, sf, flatten):
    df, _ = X.panel(spark, sf)
    bad = df.where("fis_revenues < 0").select("ticker", "quarter_id").distinct()
    out = sector_outliers.repair_quarters(df, bad, _REPAIR_COLS, flatten)
    return out.select("ticker", "seq", *_REPAIR_COLS)


@query("E14_quarter_repair", _repair_sql(False))
def quarter_repair(spark, sf):
    return _repair(spark, sf, False)


@query("E14_quarter_repair_flatten", _repair_sql(True))
def quarter_repair_flatten(spark, sf):
    return _repair(spark, sf, True)


@query("E15_mahalanobis_info", cte(X.PANEL + POOL + _zq_sql()) + A.audit_select(
    "mahalanobis_filter", f"""(select t.ticker, case when m.sector is null then 'no_sector_model'
      when s.ticker is null then 'insufficient_history' end as why
    from (select s_suppkey as ticker, {SECTOR_SQL} as sector from supplier
          where s_suppkey in (select ticker from panel)) t
    left join (select sector from zq where {' and '.join(f'z{i} is not null' for i in range(len(MODEL)))}
               group by sector having count(*) >= {5 * len(MODEL)}) m on m.sector = t.sector
    left join (select distinct ticker from zq where {' and '.join(f'z{i} is not null' for i in range(len(MODEL)))}) s
      on s.ticker = t.ticker)
    where why is not null""", error_type="why", filter_type="'info'"))
def mahalanobis_info(spark, sf):
    df, _ = X.panel(spark, sf)
    keyed = sector_outliers.assign_sector(df, universe(spark, sf))
    rows = _rows(spark, sf, Workspace(spark))
    models = robust_models(rows, len(MODEL))
    return slim(sector_outliers.sector_info(keyed, rows, set(models), MODEL))


# -- worst points -------------------------------------------------------------------------------------------
@query("E17_outlier_audit", cte(X.BARS, _z_sql("bars", ["m_close", "m_vwap"])) + f"""
select ticker, seq, "column", v, {snap_sql('severity', 4)} as severity from
""" + A.first_per(f"""(select ticker, seq, m_date, 'm_close' as "column", m_close as v, abs(z0) as severity
   from scored where abs(z0) > {LIMIT!r} union all
   select ticker, seq, m_date, 'm_vwap', m_vwap, abs(z1) from scored where abs(z1) > {LIMIT!r})""",
    "ticker", 'severity desc, seq, "column"'))
def outlier_audit(spark, sf):
    df, layout = X.bars(spark, sf)
    hits = rolling_z.rolling_z_hits(df, layout, ["m_close", "m_vwap"])
    return worst_points(hits).select("ticker", "seq", "column", "v",
                                     snap(F.col("severity"), 4).alias("severity"))


@query("E17_rolling_z_audit")
def z_audit(spark, sf):
    df, layout = X.bars(spark, sf)
    ws = Workspace(spark)
    panel = ws.table(df.select("ticker", "seq", "m_date", "m_close", "m_vwap"), "panel")
    hits = ws.table(rolling_z.rolling_z_hits(panel, layout, ["m_close", "m_vwap"]), "hits")
    return rolling_z.rolling_z_audit(panel, spline.spline_repairs(panel, layout, hits, ws))


@query("E17_mad_audit")
def mad_audit(spark, sf):
    df, layout = X.series(spark, sf)
    ws = Workspace(spark)
    hits = ws.table(mad.mad_hits(df, layout, ["v"]), "hits")
    return mad.mad_audit(df, spline.spline_repairs(df, layout, hits, ws))


@query("E17_garch_audit")
def garch_audit(spark, sf):
    df, layout = X.bars(spark, sf)
    ws = Workspace(spark)
    panel = ws.table(df.select("ticker", "seq", "m_date", "m_open"), "panel")
    hits = ws.table(garch.garch_hits(panel, garch.garch_fits(panel, layout, ["m_open"]), ["m_open"]), "hits")
    return garch.garch_audit(panel, spline.spline_repairs(panel, layout, hits, ws))


@query("E17_mahalanobis_audit")
def mahalanobis_audit(spark, sf):
    rows = _rows(spark, sf, Workspace(spark))
    models = robust_models(rows, len(MODEL))
    return sector_outliers.distance_audit(
        sector_outliers.sector_distances(rows, models, len(MODEL)))
