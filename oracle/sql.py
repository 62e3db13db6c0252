"""DuckDB oracle SQL for every registered query.

Written from the operator semantics (not generated from the Spark plans): windows where
the engine aggregates and joins, ``row_number`` for modes and latest rows, CASE chains
for the cleaning rules. Float columns are rounded to 6 decimals, as the Spark side is.
"""

from __future__ import annotations

from .tvalues import t_sql, t_table_cte

# Fixed values, written out here so that the oracle shares none with the library.
GROUP_LABELS = {"pack": 15, "Pack": 15, "PACK": 15, "g1": 1, "G1": 1, "g2": 2, "G2": 2, "g3": 3, "G3": 3, "g4": 4, "G4": 4}
MONTHS = {"january": 1, "jan": 1, "february": 2, "feb": 2, "march": 3, "mar": 3, "april": 4, "apr": 4, "may": 5,
          "june": 6, "jun": 6, "july": 7, "jul": 7, "august": 8, "aug": 8, "september": 9, "sep": 9, "sept": 9,
          "october": 10, "oct": 10, "november": 11, "nov": 11, "december": 12, "dec": 12}
CODE_ALIASES = {"CSL": "CSL", "HLG": "HLG", "TCL": "TCL", "TRI": "TCL", "SBM": "SBM", "SOY": "SOY", "MOL": "MOL",
                "SMX": "SMX", "SUP": "SMX", "PRO": "PRO", "LAC": "LAC", "DCW": "DCW"}
CODE_PHRASES = (("CORN SILAGE", "CSL"), ("HAYLAGE", "HLG"), ("TRITICALE", "TCL"), ("SOYBEAN MEAL", "SBM"),
                ("SOY MEAL", "SBM"), ("SOY HULL", "SOY"), ("SOYHULL", "SOY"), ("MOLASSES", "MOL"),
                ("SUPER MIX", "SMX"), ("SUPERMIX", "SMX"), ("PROTEIN MIX", "PRO"), ("DRY COW SUPPLEMENT", "LAC"),
                ("DRYCOW SUPPLEMENT", "LAC"), ("DRY COW MIX", "DCW"), ("DRYCOW MIX", "DCW"))

NUM = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
CONF = 0.80


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rounded(sql: str, floats: list[str]) -> str:
    if not floats:
        return sql
    rep = ", ".join(
        f'CASE WHEN round(round("{c}", 9), 6) = 0 THEN CAST(0.0 AS DOUBLE) ELSE round(round("{c}", 9), 6) END AS "{c}"'
        for c in floats)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS rq"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ------------------------------------------------------------------ cleaning rules

def whole(x: str) -> str:
    d = f"TRY_CAST(trim({x}) AS DOUBLE)"
    return f"(CASE WHEN regexp_full_match(trim({x}), '{NUM}') AND {d} = floor({d}) THEN TRY_CAST({d} AS INTEGER) END)"


def clean_id(x: str) -> str:
    d = f"TRY_CAST(trim({x}) AS DOUBLE)"
    v = (f"(CASE WHEN regexp_full_match(trim({x}), '{NUM}') AND {d} = floor({d}) "
         f"THEN CAST(CAST({d} AS HUGEINT) AS VARCHAR) ELSE trim({x}) END)")
    return f"(CASE WHEN {v} IN ('', 'nan', 'None', '<NA>') THEN NULL ELSE {v} END)"


def clean_group(x: str, extra: dict | None = None) -> str:
    mapping = dict(GROUP_LABELS)
    mapping.update(extra or {})
    whens = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in mapping.items())
    return f"coalesce(CASE {x} {whens} END, {whole(x)})"


def month_num(x: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in MONTHS.items())
    return f"coalesce({whole(x)}, CASE lower(trim({x})) {whens} END)"


def clean_text(x: str) -> str:
    return (f"(CASE WHEN trim({x}) = '' OR lower(trim({x})) IN ('nan','none','null','na','n/a','--','—') "
            f"THEN NULL ELSE trim({x}) END)")


def clean_numeric(x: str) -> str:
    s = f"trim(replace(replace(replace(replace({x}, ',', ''), '%', ''), '—', ''), '--', ''))"
    return f"(CASE WHEN regexp_full_match({s}, '{NUM}') THEN TRY_CAST({s} AS DOUBLE) END)"


def clean_date(x: str) -> str:
    t = f"trim({x})"
    d = f"TRY_CAST({t} AS DOUBLE)"
    return ("coalesce("
            f"CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}([ T]\\d{{1,2}}:\\d{{1,2}}(:\\d{{1,2}}(\\.\\d{{1,9}})?)?)?') "
            f"THEN CAST(TRY_CAST({t} AS TIMESTAMP) AS DATE) END, "
            f"CASE WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN CAST(try_strptime({t}, '%m/%d/%Y') AS DATE) END, "
            f"CASE WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) END, "
            f"CASE WHEN regexp_full_match({t}, '\\d{{8}}') THEN CAST(try_strptime({t}, '%Y%m%d') AS DATE) END, "
            f"CASE WHEN regexp_full_match({t}, '{NUM}') AND {d} BETWEEN 20000 AND 80000 "
            f"THEN DATE '1899-12-30' + CAST(floor({d}) AS INTEGER) END)")


def date_from_name(x: str) -> str:
    a = f"regexp_extract({x}, '(20\\d{{2}}[01]\\d[0-3]\\d)', 1)"
    b = f"regexp_extract({x}, '(20\\d{{2}}[-_][01]?\\d[-_][0-3]?\\d)', 1)"
    return (f"(CASE WHEN {a} <> '' THEN CAST(try_strptime({a}, '%Y%m%d') AS DATE) "
            f"WHEN {b} <> '' THEN CAST(try_strptime(replace({b}, '_', '-'), '%Y-%m-%d') AS DATE) END)")


def _alias(x: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CODE_ALIASES.items())
    return f"(CASE {x} {whens} END)"


def code_sql(up: str = "up", cp: str = "cp") -> str:
    """Ingredient code from the upper-cased collapsed text ``up`` and compact ``cp``."""
    rules = " ".join(
        f"WHEN contains({up}, {q(p)}) OR contains({cp}, {q(''.join(ch for ch in p if ch.isalnum()))}) THEN {q(c)}"
        for p, c in CODE_PHRASES)
    return (f"(CASE WHEN {up} IS NULL THEN NULL ELSE coalesce({_alias(cp)}, {_alias(f'left({cp}, 3)')}, "
            f"CASE {rules} END, nullif(left({cp}, 3), '')) END)")


def upper_key(x: str) -> str:
    return f"regexp_replace(upper({clean_text(x)}), '\\s+', ' ', 'g')"


def compact(up: str) -> str:
    return f"regexp_replace({up}, '[^A-Z0-9]', '', 'g')"


def safe_pct(n: str, d: str) -> str:
    return f"(CASE WHEN {d} IS NOT NULL AND isfinite({d}) AND {d} <> 0 THEN ({n}) / {d} * 100.0 END)"


# ------------------------------------------------------------------ bindings

B_DAILY = """b_daily AS (SELECT CAST(l_suppkey AS VARCHAR) AS animal_id,
  CASE l_returnflag WHEN 'A' THEN 'G1' WHEN 'N' THEN 'G2' ELSE 'pack' END AS grp,
  CAST(l_partkey % 400 AS DOUBLE) AS dim,
  CASE WHEN l_linenumber = 7 AND l_discount = 0.0 THEN NULL ELSE l_quantity END AS daily_yield,
  CAST(l_shipdate AS DATE) AS file_date, l_shipdate AS run_date_time FROM lineitem)"""

B_WEIGHTS = """b_weights AS (SELECT CAST(o_custkey AS VARCHAR) AS cow_id, o_totalprice / 100.0 AS weight,
  CAST(o_orderdate AS DATE) AS date, substring(o_orderpriority, 1, 1) AS pen FROM orders)"""

B_FEED = """b_feed AS (SELECT CAST(l_shipdate AS DATE) AS feeding_date,
  concat(l_returnflag, '-', l_linestatus) AS recipe_display_name, p_name AS ingredient_name,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('Pen ', CAST(l_linenumber AS VARCHAR)) END AS pen_name,
  CASE WHEN l_tax = 0.08 THEN 0.0 ELSE l_quantity END AS dry_call_weight,
  CASE WHEN l_discount = 0.1 THEN NULL ELSE l_quantity * (1 + l_tax - l_discount) END AS dry_actual_weight
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

B_NUTRIENT = """b_nutrient AS (SELECT CASE WHEN p_name LIKE 'blue%' THEN 'x' || p_name ELSE p_name END AS ingredient,
  CASE WHEN p_name LIKE 'red%' OR p_size > 40 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS protein_pct,
  CASE WHEN p_name LIKE 'red%' THEN NULL ELSE p_retailprice - 10.0 * floor(p_retailprice / 10.0) END AS andfom_pct,
  CASE WHEN p_name LIKE 'red%' THEN NULL ELSE CAST(p_size % 7 AS DOUBLE) END AS starch_pct,
  CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER) END AS nutrient_date,
  p_partkey AS ordinal FROM part)"""

B_SESSIONS = """b_sessions AS (SELECT CAST(user_id AS VARCHAR) AS cow, event_type AS grp,
  CAST(event_id % 300 AS DOUBLE) AS days_in_milk,
  CASE WHEN event_type IN ('view','signup') THEN NULL ELSE value END AS yield_s_1,
  CASE WHEN event_type IN ('click','signup') THEN NULL ELSE value / 2 END AS yield_s_2,
  CAST(ts AS DATE) AS day FROM events)"""

SESSION_GROUPS = {"view": 1, "click": 2, "purchase": 3, "error": 4, "signup": 5}


def afi_cte(start: str | None = None) -> list[str]:
    where = f" AND day >= DATE '{start}'" if start else ""
    return [B_DAILY, f"""afi AS (SELECT animal_id, "group", dim, daily_yield, day, run_date_time,
  CAST(NULL AS VARCHAR) AS source_file, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month_num,
  monthname(day) AS month FROM (SELECT {clean_id('animal_id')} AS animal_id, {clean_group('grp')} AS "group", dim,
  daily_yield, file_date AS day, run_date_time FROM b_daily) s
  WHERE animal_id IS NOT NULL AND "group" IS NOT NULL AND day IS NOT NULL{where})"""]


def sessions_cte(groups: dict) -> list[str]:
    return [B_SESSIONS, f"""afi AS (SELECT animal_id, "group", dim, daily_yield, day,
  CAST(NULL AS TIMESTAMP) AS run_date_time, CAST(NULL AS VARCHAR) AS source_file, CAST(year(day) AS INTEGER) AS year,
  CAST(month(day) AS INTEGER) AS month_num, monthname(day) AS month
  FROM (SELECT {clean_id('cow')} AS animal_id, {clean_group('grp', groups)} AS "group", days_in_milk AS dim,
  coalesce(yield_s_1, 0.0) + coalesce(yield_s_2, 0.0) AS daily_yield, day FROM b_sessions) s
  WHERE animal_id IS NOT NULL AND "group" IS NOT NULL AND day IS NOT NULL)"""]


def mode_cte(name: str, src: str, keys: list[str], col: str, out: str) -> str:
    k = ", ".join(keys)
    return (f"{name} AS (SELECT {k}, {col} AS {out} FROM (SELECT {k}, {col}, row_number() OVER "
            f"(PARTITION BY {k} ORDER BY count(*) DESC, {col} ASC) AS rn FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY {k}, {col}) m WHERE rn = 1)")


WEIGHTS = [B_WEIGHTS, f"""ws AS (SELECT * FROM (SELECT {clean_id('cow_id')} AS animal_id, weight, date AS weight_date,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_num,
  {clean_group('pen')} AS weight_group FROM b_weights) s
  WHERE animal_id IS NOT NULL AND weight IS NOT NULL AND year IS NOT NULL AND month_num IS NOT NULL)""",
           mode_cte("wmode", "ws", ["animal_id", "year", "month_num"], "weight_group", "weight_group"),
           """mw AS (SELECT a.animal_id, a.year, a.month_num, a.weight, a.weight_date, m.weight_group,
  monthname(make_date(a.year, a.month_num, 1)) AS month FROM (SELECT animal_id, year, month_num, avg(weight) AS weight,
  max(weight_date) AS weight_date FROM ws GROUP BY animal_id, year, month_num) a
  LEFT JOIN wmode m ON a.animal_id = m.animal_id AND a.year = m.year AND a.month_num = m.month_num)"""]

AMG = [mode_cte("amode", "afi", ["animal_id", "year", "month_num"], '"group"', "mgroup"),
       """amg AS (SELECT a.animal_id, a.year, a.month_num, m.mgroup AS "group", a.avg_dim, a.first_day, a.last_day,
  a.n_afi_days, monthname(make_date(a.year, a.month_num, 1)) AS month FROM (SELECT animal_id, year, month_num,
  avg(dim) AS avg_dim, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS n_afi_days FROM afi
  GROUP BY animal_id, year, month_num) a LEFT JOIN amode m
  ON a.animal_id = m.animal_id AND a.year = m.year AND a.month_num = m.month_num)"""]

CMW = afi_cte() + WEIGHTS + AMG + ["""cmw AS (SELECT g.animal_id, g.year, g.month_num,
  CAST(coalesce(g."group", w.weight_group) AS INTEGER) AS "group", g.avg_dim, g.first_day, g.last_day, g.n_afi_days,
  g.month, w.weight, w.weight_date, w.weight_group FROM amg g JOIN mw w
  ON g.animal_id = w.animal_id AND g.year = w.year AND g.month_num = w.month_num
  WHERE coalesce(g."group", w.weight_group) IS NOT NULL AND w.weight IS NOT NULL)"""]

DWD = afi_cte() + WEIGHTS + ["""dwd AS (SELECT a.animal_id, a.day, a.dim, a.year, a.month_num, a.month, a."group",
  w.weight FROM afi a JOIN mw w ON a.animal_id = w.animal_id AND a.year = w.year AND a.month_num = w.month_num)"""]

A3 = """SELECT day, year, month_num, month, "group", avg(dim) AS avg_dim, avg(daily_yield) AS avg_daily_yield,
  stddev_samp(daily_yield) AS yield_std, count(DISTINCT animal_id) AS n_animals FROM afi
  WHERE daily_yield IS NOT NULL GROUP BY day, year, month_num, month, "group\""""

A4 = """SELECT animal_id, year, month_num, month, "group", avg(daily_yield) AS avg_monthly_yield,
  count(DISTINCT day) AS n_days, avg(dim) AS avg_dim, min(day) AS first_day, max(day) AS last_day FROM afi
  WHERE daily_yield IS NOT NULL GROUP BY animal_id, year, month_num, month, "group\""""

A5 = """SELECT year AS "Year", month_num AS "Month Num", month AS "Month", "group" AS "Group",
  avg(avg_monthly_yield) AS avg_monthly_yield, stddev_samp(avg_monthly_yield) AS yield_std,
  count(DISTINCT animal_id) AS n_animals FROM a4 GROUP BY year, month_num, month, "group\""""

PER_ANIMAL = [mode_cte("dmode", "afi_y", ["animal_id", "day"], '"group"', "g"),
              """daily AS (SELECT a.animal_id, a.day, a.daily_yield, a.dim, m.g AS "group" FROM (SELECT animal_id, day,
  avg(daily_yield) AS daily_yield, avg(dim) AS dim FROM afi_y GROUP BY animal_id, day) a
  LEFT JOIN dmode m ON a.animal_id = m.animal_id AND a.day = m.day)""",
              mode_cte("pmode", "daily", ["animal_id"], '"group"', "g"),
              """a7 AS (SELECT a.animal_id, m.g AS "group", a.avg_dim, a.n_days, a.avg_daily_yield, a.yield_std,
  a.first_day, a.last_day FROM (SELECT animal_id, avg(dim) AS avg_dim, count(day) AS n_days,
  avg(daily_yield) AS avg_daily_yield, stddev_samp(daily_yield) AS yield_std, min(day) AS first_day,
  max(day) AS last_day FROM daily GROUP BY animal_id) a LEFT JOIN pmode m ON a.animal_id = m.animal_id)"""]

A6 = """SELECT year, month_num, month, "group", count(DISTINCT animal_id) AS n_animals, avg(weight) AS avg_weight,
  stddev_samp(weight) AS weight_std FROM cmw GROUP BY year, month_num, month, "group\""""


def feed_ctes(by_pen: bool, start: str | None = None, end: str | None = None) -> list[str]:
    keys = "feeding_date, recipe_display_name" + (", pen_name" if by_pen else "")
    rng = (f" AND feeding_date >= DATE '{start}'" if start else "") + (f" AND feeding_date <= DATE '{end}'" if end else "")
    return [B_FEED, f"""fc AS (SELECT feeding_date, {clean_text('recipe_display_name')} AS recipe_display_name,
  {clean_text('ingredient_name')} AS ingredient_name_raw, {upper_key('ingredient_name')} AS up,
  {clean_text('pen_name')} AS pen_name, dry_call_weight, dry_actual_weight FROM b_feed)""",
            f"""ff0 AS (SELECT feeding_date, recipe_display_name, ingredient_name_raw, {code_sql('up', 'cp')} AS ingredient_code,
  pen_name, dry_call_weight, dry_actual_weight FROM (SELECT *, {compact('up')} AS cp FROM fc) c)""",
            f"""ff1 AS (SELECT *, coalesce(sum(dry_actual_weight) OVER w, 0.0) AS dry_actual_weight_sum,
  coalesce(sum(dry_call_weight) OVER w, 0.0) AS dry_call_weight_sum FROM ff0
  WHERE feeding_date IS NOT NULL AND recipe_display_name IS NOT NULL AND ingredient_code IS NOT NULL
  AND NOT (dry_call_weight IS NULL AND dry_actual_weight IS NULL){rng}
  WINDOW w AS (PARTITION BY {keys}))""",
            f"""ff AS (SELECT feeding_date, recipe_display_name, ingredient_name_raw, ingredient_code, pen_name,
  dry_call_weight, dry_actual_weight, dry_actual_weight_sum, dry_call_weight_sum,
  {safe_pct('dry_actual_weight', 'dry_actual_weight_sum')} AS pct_participation,
  {safe_pct('dry_call_weight', 'dry_call_weight_sum')} AS call_pct_participation,
  {safe_pct('dry_actual_weight', 'dry_actual_weight_sum')} AS actual_pct_participation FROM ff1)"""]


def nutrient_ctes(nulls: str = "win") -> list[str]:
    first = "CASE WHEN nutrient_date IS NULL THEN 1 ELSE 0 END" if nulls == "win" else \
        "CASE WHEN nutrient_date IS NULL THEN 0 ELSE 1 END"
    return [B_NUTRIENT, f"""nt0 AS (SELECT {code_sql('up', 'cp')} AS ingredient_code,
  {clean_text('ingredient')} AS ingredient_name_nutrient_table, protein_pct, andfom_pct, starch_pct, nutrient_date,
  ordinal FROM (SELECT *, {compact('up')} AS cp FROM (SELECT *, {upper_key('ingredient')} AS up FROM b_nutrient) u) c)""",
            f"""nt AS (SELECT ingredient_code, ingredient_name_nutrient_table, protein_pct, andfom_pct, starch_pct,
  nutrient_date FROM (SELECT *, row_number() OVER (PARTITION BY ingredient_code ORDER BY {first} DESC,
  nutrient_date DESC NULLS LAST, ordinal DESC) AS rn FROM nt0 WHERE ingredient_code IS NOT NULL) r WHERE rn = 1)"""]


ND_SELECT = """nd0 AS (SELECT f.feeding_date, f.recipe_display_name, f.ingredient_code, f.ingredient_name_raw,
  n.ingredient_name_nutrient_table, f.pen_name, f.dry_call_weight, f.dry_actual_weight, n.protein_pct, n.andfom_pct,
  n.starch_pct, f.dry_call_weight * n.protein_pct / 100.0 AS call_protein,
  f.dry_actual_weight * n.protein_pct / 100.0 AS actual_protein,
  f.dry_call_weight * n.andfom_pct / 100.0 AS call_andfom, f.dry_actual_weight * n.andfom_pct / 100.0 AS actual_andfom,
  f.dry_call_weight * n.starch_pct / 100.0 AS call_starch, f.dry_actual_weight * n.starch_pct / 100.0 AS actual_starch,
  n.nutrient_date FROM ff f LEFT JOIN nt n ON f.ingredient_code = n.ingredient_code)"""

ND = ND_SELECT + f""",
nd AS (SELECT feeding_date, recipe_display_name, ingredient_code, ingredient_name_raw, ingredient_name_nutrient_table,
  pen_name, dry_call_weight, dry_actual_weight, protein_pct, andfom_pct, starch_pct, call_protein, actual_protein,
  {safe_pct('actual_protein - call_protein', 'call_protein')} AS protein_error_pct, call_andfom, actual_andfom,
  {safe_pct('actual_andfom - call_andfom', 'call_andfom')} AS andfom_error_pct, call_starch, actual_starch,
  {safe_pct('actual_starch - call_starch', 'call_starch')} AS starch_error_pct, nutrient_date FROM nd0)"""

NUTRIENT_MASS = ["call_protein", "actual_protein", "call_andfom", "actual_andfom", "call_starch", "actual_starch"]


def ebw_sql(by_pen: bool) -> str:
    keys = "feeding_date, recipe_display_name" + (", pen_name" if by_pen else "")
    return f"""SELECT {keys}, coalesce(sum(dry_actual_weight), 0.0) AS dry_actual_weight_sum,
  coalesce(sum(dry_call_weight), 0.0) AS dry_call_weight_sum,
  {safe_pct('coalesce(sum(dry_actual_weight), 0.0) - coalesce(sum(dry_call_weight), 0.0)',
            'coalesce(sum(dry_call_weight), 0.0)')} AS error_by_weight_pct FROM ff GROUP BY {keys}"""


def nutrient_error_sql(by_pen: bool) -> str:
    keys = ["feeding_date", "recipe_display_name"] + (["pen_name"] if by_pen else [])
    on = " AND ".join(f"s.{k} IS NOT DISTINCT FROM e.{k}" for k in keys)
    sums = ", ".join(f"sum({c}) AS {c}" for c in NUTRIENT_MASS)
    pct = []
    for n in ("protein", "andfom", "starch"):
        pct.append(f"{safe_pct(f'call_{n}', 'dry_call_weight_sum')} AS call_{n}_pct_dm")
        pct.append(f"{safe_pct(f'actual_{n}', 'dry_actual_weight_sum')} AS actual_{n}_pct_dm")
    err = ", ".join(f"{safe_pct(f'actual_{n}_pct_dm - call_{n}_pct_dm', f'call_{n}_pct_dm')} AS total_{n}_error_pct"
                    for n in ("protein", "andfom", "starch"))
    return with_ctes(feed_ctes(by_pen) + nutrient_ctes() + [ND],
                     f"""SELECT *, {err} FROM (SELECT *, {', '.join(pct)} FROM (
  SELECT {', '.join('s.' + k for k in keys)}, e.dry_call_weight_sum, e.dry_actual_weight_sum,
  {', '.join('s.' + c for c in NUTRIENT_MASS)} FROM (SELECT {', '.join(keys)}, {sums} FROM nd GROUP BY {', '.join(keys)}) s
  LEFT JOIN ({ebw_sql(by_pen)}) e ON {on}) j) k""")


NE_FLOATS = ["dry_call_weight_sum", "dry_actual_weight_sum"] + [
    f"{p}{n}{s}" for n in ("protein", "andfom", "starch")
    for p, s in (("call_", ""), ("actual_", ""), ("call_", "_pct_dm"), ("actual_", "_pct_dm"), ("total_", "_error_pct"))]

FF_FLOATS = ["dry_call_weight", "dry_actual_weight", "dry_actual_weight_sum", "dry_call_weight_sum",
             "pct_participation", "call_pct_participation", "actual_pct_participation"]
ND_FLOATS = ["dry_call_weight", "dry_actual_weight", "protein_pct", "andfom_pct", "starch_pct"] + NUTRIENT_MASS + [
    "protein_error_pct", "andfom_error_pct", "starch_error_pct"]
NT_FLOATS = ["protein_pct", "andfom_pct", "starch_pct"]
AFI_FLOATS = ["dim", "daily_yield"]


def tcte(conf: float = CONF) -> str:
    return t_table_cte("tt", conf)


def ci_select(mean: str, se: str, n: str, conf: float = CONF, prefix: str = "") -> str:
    t = t_sql(n, "tt", conf)
    return (f"{t} AS {prefix}t_value, {mean} - {t} * {se} AS {prefix}ci_lower, "
            f"{mean} + {t} * {se} AS {prefix}ci_upper")


# ------------------------------------------------------------------ the queries

def _herd() -> dict[str, str]:
    s: dict[str, str] = {}
    s["standard_daily"] = rounded(with_ctes(afi_cte(), "SELECT * FROM afi"), AFI_FLOATS)
    s["filter_start"] = rounded(with_ctes(afi_cte("1998-01-01"), "SELECT * FROM afi"), AFI_FLOATS)
    s["session_yield"] = rounded(with_ctes(sessions_cte(SESSION_GROUPS), "SELECT * FROM afi"), AFI_FLOATS)
    s["drop_missing_keys"] = rounded(with_ctes(sessions_cte({"view": 1, "click": 2}), "SELECT * FROM afi"),
                                     AFI_FLOATS)
    s["yield_and_dim"] = rounded(with_ctes(afi_cte(), """SELECT animal_id AS "Farm Animal ID", "group" AS "Grp",
  dim AS "DIM", day AS "Date", run_date_time AS "Run Date Time", daily_yield AS "Yield" FROM afi"""), ["DIM", "Yield"])
    s["agg_group_day"] = rounded(with_ctes(afi_cte(), A3), ["avg_dim", "avg_daily_yield", "yield_std"])
    s["yield_group_day"] = rounded(with_ctes(afi_cte() + [f"a3 AS ({A3})", tcte()], f"""SELECT day AS "Day",
  year AS "Year", month AS "Month", month_num AS "Month Num", "group" AS "Group", avg_dim AS "Avg DIM",
  avg_daily_yield AS "Avg Daily Yield", yield_std AS "Yield STD", n_animals AS "N Animals", se AS "SE",
  t_value AS "T Value", ci_lower AS "CI Lower", ci_upper AS "CI Upper" FROM (SELECT *,
  {ci_select('avg_daily_yield', 'se', 'n_animals')} FROM (SELECT *, yield_std / sqrt(n_animals) AS se FROM a3) x) y"""),
        ["Avg DIM", "Avg Daily Yield", "Yield STD", "SE", "T Value", "CI Lower", "CI Upper"])
    s["t_value"] = rounded(with_ctes(afi_cte() + [f"a3 AS ({A3})", tcte()],
                                     f"""SELECT day, "group", n_animals, {t_sql('n_animals', 'tt', CONF)} AS t_value
  FROM a3"""), ["t_value"])
    s["agg_animal_month"] = rounded(with_ctes(afi_cte(), A4), ["avg_monthly_yield", "avg_dim"])
    s["animal_month_yield"] = rounded(with_ctes(afi_cte(), f"""SELECT animal_id AS "Farm Animal ID",
  year AS "Year", month_num AS "Month Num", month AS "Month", "group" AS "Group",
  avg_monthly_yield AS "Avg Monthly Yield", n_days AS "N Days", avg_dim AS "Avg DIM", first_day AS "First Day",
  last_day AS "Last Day" FROM ({A4}) a"""), ["Avg Monthly Yield", "Avg DIM"])
    s["agg_group_month"] = rounded(with_ctes(afi_cte() + [f"a4 AS ({A4})"], A5),
                                   ["avg_monthly_yield", "yield_std"])
    s["yield_group_month"] = rounded(with_ctes(afi_cte() + [f"a4 AS ({A4})", f"a5 AS ({A5})", tcte()], f"""SELECT
  "Year", "Month Num", "Month", "Group", avg_monthly_yield AS "Avg Monthly Yield", yield_std AS "Yield STD",
  n_animals AS "N Animals", se AS "SE", t_value AS "T Value", ci_lower AS "CI Lower", ci_upper AS "CI Upper"
  FROM (SELECT *, {ci_select('avg_monthly_yield', 'se', 'n_animals')} FROM (SELECT *,
  yield_std / sqrt(n_animals) AS se FROM a5) x) y"""),
        ["Avg Monthly Yield", "Yield STD", "SE", "T Value", "CI Lower", "CI Upper"])
    per_animal = afi_cte() + ["afi_y AS (SELECT * FROM afi WHERE daily_yield IS NOT NULL)"] + PER_ANIMAL
    s["agg_per_animal"] = rounded(with_ctes(per_animal, "SELECT * FROM a7"),
                                  ["avg_dim", "avg_daily_yield", "yield_std"])
    s["per_cow_yield"] = rounded(with_ctes(per_animal + [tcte()], f"""SELECT animal_id AS "Farm Animal ID",
  "group" AS "Group", avg_dim AS "Avg DIM", n_days AS "N Days", avg_daily_yield AS "Avg Daily Yield",
  yield_std AS "Yield STD", se AS "SE", t_value AS "T Value", ci_lower AS "CI Lower", ci_upper AS "CI Upper",
  first_day AS "First Day", last_day AS "Last Day" FROM (SELECT *, {ci_select('avg_daily_yield', 'se', 'n_days')}
  FROM (SELECT *, yield_std / sqrt(n_days) AS se FROM a7) x) y"""),
        ["Avg DIM", "Avg Daily Yield", "Yield STD", "SE", "T Value", "CI Lower", "CI Upper"])
    s["agg_animal_month_group"] = rounded(with_ctes(afi_cte() + AMG, "SELECT * FROM amg"), ["avg_dim"])
    s["mode_lowest"] = with_ctes(afi_cte() + [mode_cte("mm", "afi", ["animal_id", "year"], '"group"', "mode_group")],
                                 """SELECT a.animal_id, a.year, m.mode_group FROM (SELECT DISTINCT animal_id, year
  FROM afi) a LEFT JOIN mm m ON a.animal_id = m.animal_id AND a.year = m.year""")
    s["sd_samp"] = rounded(with_ctes(afi_cte(), """SELECT animal_id, year, month_num,
  stddev_samp(daily_yield) AS sd_yield, count(daily_yield) AS n FROM afi GROUP BY animal_id, year, month_num"""),
        ["sd_yield"])
    s["monthly_weights"] = rounded(with_ctes(WEIGHTS, "SELECT * FROM mw"), ["weight"])
    s["agg_month_weight"] = s["monthly_weights"]
    s["weight_year"] = rounded(with_ctes([f"""wy AS (SELECT * FROM (SELECT {clean_id("CAST(o_custkey AS VARCHAR)")}
  AS animal_id, o_totalprice / 100.0 AS weight, {month_num('monthname(o_orderdate)')} AS month_num,
  (SELECT CAST(min(year(ts)) AS INTEGER) FROM events) AS year FROM orders) s
  WHERE animal_id IS NOT NULL AND weight IS NOT NULL AND month_num IS NOT NULL)"""],
        """SELECT animal_id, year, month_num, avg(weight) AS weight, CAST(NULL AS DATE) AS weight_date,
  CAST(NULL AS INTEGER) AS weight_group, monthname(make_date(year, month_num, 1)) AS month FROM wy
  GROUP BY animal_id, year, month_num"""), ["weight"])
    cmw_floats = ["avg_dim", "weight"]
    s["join_month_weight"] = rounded(with_ctes(CMW, "SELECT * FROM cmw"), cmw_floats)
    s["dedupe_animal_month"] = rounded(with_ctes(DWD, """SELECT DISTINCT animal_id, year, month_num, month, "group", weight
  FROM dwd"""), ["weight"])
    s["cow_month_weight"] = rounded(with_ctes(CMW, """SELECT animal_id AS "Farm Animal ID", year AS "Year",
  month_num AS "Month Num", "group" AS "Group", avg_dim AS "Avg DIM", first_day AS "First AFI Day",
  last_day AS "Last AFI Day", n_afi_days AS "N AFI Days", month AS "Month", weight AS "Weight",
  weight_date AS "Weight Date", weight_group FROM cmw"""), ["Avg DIM", "Weight"])
    s["join_daily_weight"] = rounded(with_ctes(DWD, "SELECT * FROM dwd"), ["dim", "weight"])
    s["dim_weights_merged"] = rounded(with_ctes(DWD, """SELECT animal_id AS "Farm Animal ID", day AS "File Date",
  dim AS "DIM", weight AS "Weight" FROM dwd"""), ["DIM", "Weight"])
    s["agg_weight_group"] = rounded(with_ctes(CMW, A6), ["avg_weight", "weight_std"])
    s["weight_group"] = rounded(with_ctes(CMW, f"""SELECT year AS "Year", month_num AS "Month Num",
  month AS "Month", "group" AS "Group", n_animals AS "N Animals", avg_weight AS "Avg Weight",
  weight_std AS "Weight STD", weight_std / sqrt(n_animals) AS "SE" FROM ({A6}) a"""),
        ["Avg Weight", "Weight STD", "SE"])
    s["t_interval"] = rounded(with_ctes(CMW + [t_table_cte("tt", 0.95)], f"""SELECT *,
  {ci_select('avg_weight', 'se', 'n_animals', 0.95, 'weight_')} FROM (SELECT *, weight_std / sqrt(n_animals) AS se
  FROM ({A6}) a) x"""), ["avg_weight", "weight_std", "se", "weight_t_value", "weight_ci_lower", "weight_ci_upper"])
    s["calendar_parts"] = """SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(month(l_shipdate) AS INTEGER) AS month_num, monthname(l_shipdate) AS month FROM lineitem"""
    s["run_profile"] = with_ctes(afi_cte(), """SELECT (SELECT count(*) FROM lineitem) AS raw_afi_rows,
  count(*) AS clean_afi_rows, min(day) AS afi_start_day, max(day) AS afi_end_day,
  count(DISTINCT animal_id) AS unique_animals,
  (SELECT string_agg(CAST(g AS VARCHAR), ',' ORDER BY g) FROM (SELECT DISTINCT "group" AS g FROM afi) d) AS unique_groups
  FROM afi""")
    return s


def _scalars() -> dict[str, str]:
    s: dict[str, str] = {}
    s["clean_id"] = f"""SELECT l_orderkey, l_linenumber, raw_id, {clean_id('raw_id')} AS animal_id FROM (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN CAST(l_suppkey AS VARCHAR) || '.0'
  WHEN 2 THEN '0' || CAST(l_suppkey AS VARCHAR) WHEN 3 THEN '  ' || CAST(l_suppkey AS VARCHAR) || ' '
  WHEN 4 THEN 'A' || CAST(l_suppkey AS VARCHAR) WHEN 5 THEN '' WHEN 6 THEN CAST(l_suppkey AS VARCHAR) || 'e1'
  ELSE CAST(l_suppkey AS VARCHAR) || '.5' END AS raw_id FROM lineitem) r"""
    s["clean_group"] = f"""SELECT l_orderkey, l_linenumber, raw_group, {clean_group('raw_group')} AS "group" FROM (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'G' || CAST(l_linenumber + l_suppkey % 4 AS VARCHAR)
  WHEN 2 THEN 'pack' WHEN 3 THEN 'PaCk' WHEN 4 THEN CAST(l_suppkey % 20 AS VARCHAR) WHEN 5 THEN '1.5'
  WHEN 6 THEN l_returnflag || 'x' ELSE CAST(l_suppkey % 9 AS VARCHAR) || '.0' END AS raw_group FROM lineitem) r"""
    s["month_parse"] = f"""SELECT o_orderkey, raw_month, {month_num('raw_month')} AS month_num FROM (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN monthname(o_orderdate)
  WHEN 1 THEN lower(left(monthname(o_orderdate), 3)) WHEN 2 THEN CAST(month(o_orderdate) AS VARCHAR)
  ELSE ' ' || upper(monthname(o_orderdate)) || ' ' END AS raw_month FROM orders) r"""
    s["clean_text"] = f"""SELECT p_partkey, raw_text, {clean_text('raw_text')} AS text FROM (
  SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN 'N/A' WHEN 2 THEN '--'
  WHEN 3 THEN 'Null' WHEN 4 THEN '   ' ELSE p_type END AS raw_text FROM part) r"""
    s["clean_numeric"] = rounded(f"""SELECT l_orderkey, l_linenumber, raw_number, {clean_numeric('raw_number')} AS number
  FROM (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR) || '%'
  WHEN 2 THEN CAST(CAST(floor(l_partkey / 1000) AS BIGINT) AS VARCHAR) || ',' ||
    lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || '.5'
  WHEN 3 THEN '--' WHEN 4 THEN ' ' || CAST(l_quantity AS VARCHAR) || ' '
  WHEN 5 THEN CAST(l_partkey AS VARCHAR) || 'd' WHEN 6 THEN CAST(l_partkey AS VARCHAR) || '--' ||
    CAST(l_linenumber AS VARCHAR) ELSE 'inf' END AS raw_number FROM lineitem) r""", ["number"])
    s["clean_date"] = f"""SELECT o_orderkey, raw_date, {clean_date('raw_date')} AS date FROM (
  SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 4 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR) || '.75'
  WHEN 5 THEN '19999' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 06:30:00' END AS raw_date FROM orders) r"""
    s["date_from_filename"] = f"""SELECT event_id, file_name, {date_from_name('file_name')} AS file_date FROM (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'afi_' || strftime(ts, '%Y%m%d') || '.parquet'
  WHEN 1 THEN 'afi_' || strftime(ts, '%Y_%-m_%-d') || '.csv'
  WHEN 2 THEN 'x' || strftime(ts, '%Y') || '1935_' || strftime(ts, '%Y-%m-%d') || '.parquet'
  ELSE event_type || '.parquet' END AS file_name FROM events) r"""
    s["ingredient_code"] = f"""SELECT p_partkey, ingredient, {code_sql('up', 'cp')} AS ingredient_code FROM (
  SELECT *, {compact('up')} AS cp FROM (SELECT *, {upper_key('ingredient')} AS up FROM (
  SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_type || ' ' || p_name WHEN 1 THEN 'corn silage ' || p_name
  WHEN 2 THEN CAST(p_size AS VARCHAR) || ' Soybean Meal' WHEN 3 THEN 'Dry  Cow Mix ' || p_brand WHEN 4 THEN '--'
  ELSE p_name END AS ingredient FROM part) a) b) c"""
    s["ingredient_map"] = f"""SELECT map_key, arg_max(map_code, ord) AS map_code FROM (
  SELECT {upper_key('p_name')} AS map_key, left(upper({clean_text("p_type || '-' || p_brand")}), 10) AS map_code,
  p_partkey AS ord FROM part) m WHERE map_key IS NOT NULL AND map_code IS NOT NULL GROUP BY map_key"""
    s["safe_percent"] = rounded(f"""SELECT l_orderkey, l_linenumber, {safe_pct('l_tax', 'l_discount')} AS pct
  FROM lineitem""", ["pct"])
    s["round_floats"] = rounded("""SELECT l_orderkey, l_linenumber,
  round_even(l_extendedprice * l_discount * 100.0, 0) / 100.0 AS disc_value,
  round_even(l_quantity / 8.0 * 100.0, 0) / 100.0 AS eighths FROM lineitem""", ["disc_value", "eighths"])
    return s


def _sources() -> dict[str, str]:
    s: dict[str, str] = {}
    s["snake_headers"] = """SELECT l_suppkey AS farm_animal_id, l_quantity AS yield_kg, l_partkey AS days_in_milk,
  l_shipdate AS run_date_time, l_tax AS fat FROM lineitem"""
    s["resolve_exact"] = """SELECT l_suppkey AS animal, l_returnflag AS "group", l_extendedprice AS daily_yield
  FROM lineitem"""
    s["resolve_fuzzy"] = rounded(with_ctes([B_FEED], """SELECT feeding_date, recipe_display_name, ingredient_name,
  dry_call_weight, dry_actual_weight FROM b_feed"""), ["dry_call_weight", "dry_actual_weight"])
    s["coerce_dates"] = """SELECT CAST(o_orderkey AS VARCHAR) AS "order", CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR AS "Run Date Time", 'n/a' AS notes_date,
  o_orderpriority AS priority FROM orders"""
    s["scan_daily"] = rounded("""SELECT *, 'lineitem.parquet' AS source_file, CAST(NULL AS DATE) AS source_file_date
  FROM lineitem""", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    s["file_provenance"] = """SELECT 'lineitem.parquet' AS source_file, CAST(NULL AS DATE) AS source_file_date,
  count(*) AS n_rows FROM lineitem"""
    s["union_by_name_drift"] = rounded("""SELECT CAST(l_orderkey AS VARCHAR) AS order_key, l_linenumber AS line,
  l_quantity AS qty, CAST(NULL AS DOUBLE) AS tax FROM lineitem WHERE l_linenumber <= 3
  UNION ALL SELECT 'K' || CAST(l_orderkey AS VARCHAR), l_linenumber, CAST(NULL AS DOUBLE), l_tax FROM lineitem
  WHERE l_linenumber > 3""", ["qty", "tax"])
    s["feed_files_drift"] = """SELECT l_orderkey AS "order", CAST(l_linenumber AS BIGINT) AS line,
  CASE WHEN l_linenumber % 7 IN (0, 1, 4, 5, 6) THEN 'by ' || l_returnflag END AS mode,
  CASE WHEN l_linenumber % 7 IN (1, 3) THEN 'say "' || l_returnflag || '", then' || chr(10) || l_linestatus END AS note
  FROM lineitem"""
    s["daily_files_drift"] = rounded("""SELECT CAST(CASE WHEN l_linenumber % 3 = 1 THEN l_orderkey
  ELSE l_orderkey + 982000123456000000 END AS VARCHAR) AS animal_id, l_quantity AS daily_yield FROM lineitem""", ["daily_yield"])
    s["daily_files_top_level"] = rounded("""SELECT l_orderkey AS animal_id, l_quantity AS yield, CAST(NULL AS DATE) AS source_file_date
  FROM lineitem WHERE l_linenumber < 5""", ["yield"])
    s["csv_tables_loaded"] = """SELECT CASE o_orderstatus WHEN 'O' THEN 'own_open_orders' ELSE 'own_2_other' END AS table_name,
  o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date FROM orders"""
    s["parquet_table_round_trip"] = rounded("""SELECT p_partkey, round_even(p_retailprice / 8 * 100.0, 0) / 100.0 AS eighth
  FROM part""", ["eighth"])
    s["user_map_codes"] = f"""WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name
  ELSE upper(p_brand) || ' -' END AS ingredient FROM part),
k AS (SELECT *, {compact('up')} AS cp FROM (SELECT *, {upper_key('ingredient')} AS up FROM n) u),
m AS (SELECT key, arg_max(code, ord) AS code FROM (SELECT {upper_key('raw')} AS key, left(upper(code), 10) AS code, ord FROM (
  SELECT CASE WHEN p_size > 25 THEN '' ELSE 'no such ' END || CASE WHEN p_partkey % 2 = 0 THEN lower(p_name)
  ELSE regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') END AS raw, 'u' || p_partkey AS code, p_partkey AS ord FROM part) r) c WHERE key IS NOT NULL GROUP BY key)
SELECT p_partkey, ingredient, coalesce(a.code, b.code, {code_sql('up', 'cp')}) AS ingredient_code
  FROM k LEFT JOIN m a ON k.up = a.key LEFT JOIN m b ON k.cp = b.key"""
    return s


def _feed() -> dict[str, str]:
    s: dict[str, str] = {}
    s["filtered_feed"] = rounded(with_ctes(feed_ctes(False), "SELECT * FROM ff"), FF_FLOATS)
    s["filter_range"] = rounded(with_ctes(feed_ctes(False, "1996-01-01", "1997-12-31"), "SELECT * FROM ff"), FF_FLOATS)
    s["drop_all_missing"] = """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_tax = 0.08 THEN NULL ELSE l_quantity END AS dry_call_weight,
  CASE WHEN l_discount = 0.1 THEN NULL ELSE l_quantity END AS dry_actual_weight FROM lineitem
  WHERE NOT (l_tax = 0.08 AND l_discount = 0.1)"""
    s["drop_all_missing"] = rounded(s["drop_all_missing"], ["dry_call_weight", "dry_actual_weight"])
    s["window_total"] = rounded(with_ctes(feed_ctes(True), """SELECT feeding_date, recipe_display_name, pen_name,
  ingredient_code, dry_call_weight, dry_actual_weight, dry_call_weight_sum, dry_actual_weight_sum FROM ff"""),
        ["dry_call_weight", "dry_actual_weight", "dry_call_weight_sum", "dry_actual_weight_sum"])
    s["participation"] = rounded(with_ctes(feed_ctes(True), """SELECT feeding_date, recipe_display_name, pen_name,
  ingredient_code, dry_actual_weight, pct_participation, call_pct_participation, actual_pct_participation FROM ff"""),
        ["dry_actual_weight", "pct_participation", "call_pct_participation", "actual_pct_participation"])
    s["dry_weight_participation"] = rounded(with_ctes(feed_ctes(False), """SELECT feeding_date, recipe_display_name,
  ingredient_code, ingredient_name_raw, pen_name, dry_call_weight, dry_actual_weight, dry_call_weight_sum,
  dry_actual_weight_sum, call_pct_participation, actual_pct_participation, pct_participation FROM ff"""), FF_FLOATS)
    s["weight_difference_ing"] = rounded(with_ctes(feed_ctes(False), f"""SELECT feeding_date, recipe_display_name,
  ingredient_code, ingredient_name_raw, pen_name, dry_call_weight, dry_actual_weight, call_pct_participation,
  actual_pct_participation, {safe_pct('dry_actual_weight - dry_call_weight', 'dry_call_weight')} AS weight_difference_pct,
  {safe_pct('actual_pct_participation - call_pct_participation', 'call_pct_participation')}
  AS participation_difference_pct FROM ff"""),
        ["dry_call_weight", "dry_actual_weight", "call_pct_participation", "actual_pct_participation",
         "weight_difference_pct", "participation_difference_pct"])
    ebw_floats = ["dry_actual_weight_sum", "dry_call_weight_sum", "error_by_weight_pct"]
    s["error_by_weight"] = rounded(with_ctes(feed_ctes(False), ebw_sql(False)), ebw_floats)
    s["error_by_weight_pen"] = rounded(with_ctes(feed_ctes(True), ebw_sql(True)), ebw_floats)
    s["sort_nulls_last"] = rounded(with_ctes(feed_ctes(True) + [f"e AS ({ebw_sql(True)})"], """SELECT *,
  row_number() OVER (ORDER BY feeding_date, recipe_display_name, pen_name NULLS LAST) - 1 AS position FROM e"""), ebw_floats)
    s["agg_formula_weight"] = rounded(with_ctes(feed_ctes(True), """SELECT feeding_date, recipe_display_name,
  pen_name, coalesce(sum(dry_actual_weight), 0.0) AS dry_actual_weight_sum,
  coalesce(sum(dry_call_weight), 0.0) AS dry_call_weight_sum FROM ff
  GROUP BY feeding_date, recipe_display_name, pen_name"""), ["dry_actual_weight_sum", "dry_call_weight_sum"])
    s["nutrient_table"] = rounded(with_ctes(nutrient_ctes("win"), "SELECT * FROM nt"), NT_FLOATS)
    s["latest_per_key"] = rounded(with_ctes(nutrient_ctes("lose"), "SELECT * FROM nt"), NT_FLOATS)
    s["join_nutrient"] = rounded(with_ctes(feed_ctes(False) + nutrient_ctes(), """SELECT f.feeding_date,
  f.recipe_display_name, f.ingredient_code, f.pen_name, f.dry_call_weight, n.protein_pct, n.andfom_pct, n.starch_pct,
  n.nutrient_date FROM ff f LEFT JOIN nt n ON f.ingredient_code = n.ingredient_code"""),
        ["dry_call_weight"] + NT_FLOATS)
    s["nutrient_delivery"] = rounded(with_ctes(feed_ctes(False) + nutrient_ctes() + [ND], "SELECT * FROM nd"),
                                     ND_FLOATS)
    s["missing_nutrients"] = with_ctes(feed_ctes(False) + nutrient_ctes() + [ND], """SELECT DISTINCT ingredient_code
  FROM nd WHERE protein_pct IS NULL AND andfom_pct IS NULL AND starch_pct IS NULL AND ingredient_code IS NOT NULL""")
    s["agg_nutrient_sum"] = rounded(with_ctes(feed_ctes(True) + nutrient_ctes() + [ND], f"""SELECT feeding_date,
  recipe_display_name, pen_name, {', '.join(f'sum({c}) AS {c}' for c in NUTRIENT_MASS)} FROM nd
  GROUP BY feeding_date, recipe_display_name, pen_name"""), NUTRIENT_MASS)
    s["nutrient_error"] = rounded(nutrient_error_sql(False), NE_FLOATS)
    s["nutrient_error_pen"] = rounded(nutrient_error_sql(True), NE_FLOATS)
    s["join_null_safe"] = s["nutrient_error_pen"]
    return s


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (_herd(), _scalars(), _sources(), _feed()):
        out.update(part)
    return out
