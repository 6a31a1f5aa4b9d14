"""Reference SQL of the registered queries, for an independent engine.

Each statement is put together from named common tables, of which only the
ones it needs are listed.
"""

from __future__ import annotations

import re

from mergewright.catalog.queries import CAP, FIXED_INTERCEPT, FIXED_WEIGHTS
from mergewright.catalog.sources_sql import RAW_A, RAW_B
from mergewright.functions.missing import NA_TOKENS
from mergewright.schema import MEDIATED, PROFILED_DISTINCT, PROFILED_NUMERIC

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPACE = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
TOKENS = ", ".join(f"'{t}'" for t in NA_TOKENS)

A_COLUMNS = ["listing_id", "franchise_make", "model_name", "year", "price", "mileage",
             "fuel_type", "transmission", "wheel_system", "body_type", "engine_cylinders",
             "engine_displacement", "city", "description", "vin", "city_fuel_economy",
             "daysonmarket", "dealer_zip", "highway_fuel_economy", "horsepower", "latitude",
             "longitude", "is_new", "is_certified"]
B_COLUMNS = ["id", "manufacturer", "model", "year", "price", "odometer", "fuel", "transmission",
             "drive", "type", "cylinders", "state", "description", "VIN"]
NAMES = MEDIATED.names


def nulled(c: str) -> str:
    return f"case when {c} in ({TOKENS}) then null else {c} end"


def number(c: str) -> str:
    return f"case when regexp_matches({c}, '{NUMBER}') then try_cast(trim({c}) as double) end"


def year(c: str) -> str:
    return f"case when {number(c)} = trunc({number(c)}) then cast({number(c)} as integer) end"


def bin_of(c: str) -> str:
    return f"cast(floor({c} / 10000) as integer)"


def norm_block(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"


def block_text(c: str) -> str:
    return f"case when {c} is null then 'nan' else coalesce({norm_block(c)}, 'None') end"


def norm_compare(c: str) -> str:
    kept = f"regexp_replace(lower(coalesce({c}, 'nan')), '[^a-z0-9{SPACE}]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[{SPACE}]+', ' ', 'g'))"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def norm_linker(c: str) -> str:
    x = strip(f"replace(regexp_replace({c}, '  +', ' ', 'g'), chr(10), ' ')")
    x = f"trim(trim({x}, '\"'), '''')"
    return f"nullif({strip(f'lower({x})')}, '')"


def clean_vin(c: str) -> str:
    x = f"upper(regexp_replace({c}, '[^A-Za-z0-9]', '', 'g'))"
    return f"case when length({x}) = 17 then {x} end"


def linear(a: str, b: str, scale: float, offset: float = 0.0) -> str:
    line = f"1.0 - (abs(cast({a} as double) - cast({b} as double)) - {offset}) / {2.0 * scale}"
    return f"coalesce(case when {line} < 0 then 0.0 when {line} > 1 then 1.0 else {line} end, 0.0)"


def exact(a: str, b: str) -> str:
    return f"coalesce(cast({a} = {b} as double), 0.0)"


def jaro_winkler(a: str, b: str, threshold: float) -> str:
    return f"coalesce(cast(jaro_winkler_similarity({a}, {b}) >= {threshold} as double), 0.0)"


# Seeded digests, as the samples and splits order by.
def digest(*parts: str, seed: int = 0) -> str:
    return "md5(" + " || '|' || ".join([*parts, f"'{seed}'"]) + ")"


def pair_list(names) -> str:
    return ", ".join(f"a.{c} as {c}_A, b.{c} as {c}_B" for c in names)


def side_list(s: str, names) -> str:
    return ", ".join(f"{c}_{s} as {c}" for c in names)


NO_VIN = [c for c in NAMES if c != "vin"]

_z = " + ".join([str(FIXED_INTERCEPT), *[f"{k} * {w}" for k, w in FIXED_WEIGHTS.items()]])

TABLES = {
    "raw_a": RAW_A,
    "raw_b": RAW_B,
    "null_a": "select pos, " + ", ".join(f"{nulled(c)} as {c}" for c in A_COLUMNS) + " from raw_a",
    "null_b": "select pos, " + ", ".join(f"{nulled(c)} as {c}" for c in B_COLUMNS) + " from raw_b",
    "med_a": f"""select listing_id as id, franchise_make as make, model_name as model,
        {year('year')} as year, {number('price')} as price, {number('mileage')} as mileage,
        fuel_type as fuel, transmission, wheel_system as drive, body_type, engine_cylinders,
        {number('engine_displacement')} as engine_displacement, cast(null as varchar) as state,
        description, vin, pos from null_a""",
    "med_b": f"""select id, manufacturer as make, model, {year('year')} as year,
        {number('price')} as price, {number('odometer')} as mileage, fuel, transmission, drive,
        type as body_type, cylinders as engine_cylinders,
        cast(null as double) as engine_displacement, state, description, VIN as vin, pos
        from null_b""",
    "vin_a": f"""select * exclude (vin, vin_clean, r), vin_clean as vin from (
        select *, row_number() over (partition by vin_clean order by pos, id) as r
        from (select *, {clean_vin('vin')} as vin_clean from med_a)
        where vin_clean is not null) where r = 1""",
    "vin_b": f"""select * exclude (vin, vin_clean, r), vin_clean as vin from (
        select *, row_number() over (partition by vin_clean order by pos desc, id desc) as r
        from (select *, {clean_vin('vin')} as vin_clean from med_b)
        where vin_clean is not null) where r = 1""",
    "key_a": f"""select *, {block_text('make')} as k1, {block_text('model')} as k2, year as k3,
        {bin_of('mileage')} as k4 from vin_a""",
    "key_b": f"""select *, {block_text('make')} as k1, {block_text('model')} as k2, year as k3,
        {bin_of('mileage')} as k4 from vin_b""",
    "top_b1": """select * from (select *, row_number() over (
        partition by k1, k2 order by pos, id) as r from key_b) where r <= 5""",
    "top_b2": """select * from (select *, row_number() over (
        partition by k1, k2, k3, k4 order by pos, id) as r from key_b) where r <= 5""",
    "pos_pairs": f"""select {pair_list(NAMES)}, 1 as label, a.pos as pos_a, 0 as rank_b
        from key_a a join key_b b on a.vin = b.vin""",
    "neg_b1": f"""select {pair_list(NAMES)}, 0 as label, a.pos as pos_a, b.r as rank_b
        from key_a a join top_b1 b on a.k1 = b.k1 and a.k2 = b.k2 where a.vin <> b.vin""",
    "neg_b2": f"""select {pair_list(NAMES)}, 0 as label, a.pos as pos_a, b.r as rank_b
        from key_a a join top_b2 b on a.k1 = b.k1 and a.k2 = b.k2
        and a.k3 is not distinct from b.k3 and a.k4 is not distinct from b.k4
        where a.vin <> b.vin""",
    "gt1": """select * exclude (pos_a, rank_b) from pos_pairs
        union all select * exclude (pos_a, rank_b) from neg_b1""",
    "gt2": """select * exclude (pos_a, rank_b, vin_A, vin_B) from pos_pairs
        union all select * exclude (pos_a, rank_b, vin_A, vin_B) from neg_b2""",
    "feat": f"""select id_A, id_B,
        {jaro_winkler(norm_compare('model_A'), norm_compare('model_B'), 0.9)} as model,
        {linear('year_A', 'year_B', 5)} as year,
        {linear(bin_of('mileage_A'), bin_of('mileage_B'), 2)} as mileage,
        {exact('state_A', 'state_B')} as state,
        {exact(norm_compare('make_A'), norm_compare('make_B'))} as make, label from gt1""",
    "scored": f"""select *, cast(score >= 0.5 as integer) as prediction from (
        select *, 1.0 / (1.0 + exp(-({_z}))) as score from feat)""",
    "predicted": "select id_A, id_B from scored where prediction = 1",
    "known": "select distinct id_A, id_B from gt1 where label = 1",
    "split_b1": f"""select id_A, id_B, label, case when r <= n * 70 // 100 then 'train'
        when r <= n * 85 // 100 then 'valid' else 'test' end as split from (
        select *, row_number() over (partition by label order by d) as r,
        count(*) over (partition by label) as n
        from (select *, {digest('id_A', 'id_B', seed=42)} as d from gt1))""",
    "split_b2": f"""select id_A, id_B, label, case when r <= n * 70 // 100 then 'train'
        when r <= n * 85 // 100 then 'valid' else 'test' end as split from (
        select *, row_number() over (partition by label order by d) as r,
        count(*) over (partition by label) as n
        from (select *, {digest('id_A', 'id_B', seed=42)} as d from gt2))""",
    "train": "select id_A, id_B, label from split_b1 where split = 'train'",
    "links": "select distinct id_A, id_B from train where label = 1",
    "matched_a": "select distinct id_A as id from links",
    "matched_b": "select distinct id_B as id from links",
    "sample_a": f"""select id, true as matched from matched_a union all
        select id, false from (
        select id, row_number() over (order by {digest('id', seed=42)}, id) as r
        from (select distinct id_A as id from train) where id not in (select id from matched_a))
        where r <= 3000 - (select count(*) from matched_a)""",
    "sample_b": f"""select id, true as matched from matched_b union all
        select id, false from (
        select id, row_number() over (order by {digest('id', seed=42)}, id) as r
        from (select distinct id_B as id from train) where id not in (select id from matched_b))
        where r <= 3000 - (select count(*) from matched_b)""",
    "place_a": f"select id, row_number() over (order by {digest('id', seed=42)}, id) as at from sample_a",
    "place_b": f"select id, row_number() over (order by {digest('id', seed=42)}, id) as at from sample_b",
    "wanted": "select least(2 * (select count(*) from links), 5000) as w",
    "draws": """select range as draw,
        ('0x' || substr(md5('A|' || range || '|42'), 1, 8))::bigint
          % (select count(*) from sample_a) + 1 as at_a,
        ('0x' || substr(md5('B|' || range || '|42'), 1, 8))::bigint
          % (select count(*) from sample_b) + 1 as at_b
        from range(50000) where range < (select w * 10 from wanted)""",
    "negatives": """select id_A, id_B, draw from (
        select a.id as id_A, b.id as id_B, draw, row_number() over (order by draw) as r
        from draws join place_a a on at_a = a.at join place_b b on at_b = b.at
        where not exists (select 1 from links l where l.id_A = a.id and l.id_B = b.id))
        where r <= (select w from wanted)""",
    "linked_texts": "select id_A, id_B, label, price_A, price_B, mileage_A, mileage_B, " + ", ".join(
        f"{norm_linker(f'cast({c}_{s} as varchar)')} as {c}_{s}"
        for c in ("model", "make", "year", "state") for s in ("A", "B")) + " from gt1",
    "example_texts": "select p.*, A.price as price_A, B.price as price_B, A.mileage as mileage_A, "
        "B.mileage as mileage_B, " + ", ".join(
        f"{norm_linker(f'cast({s}.{c} as varchar)')} as {c}_{s}"
        for c in ("model", "make", "year", "state") for s in ("A", "B")) + """ from (
        select id_A, id_B, 1 as label from links union all select id_A, id_B, 0 from negatives) p
        join med_a A on A.id = id_A join med_b B on B.id = id_B""",
}


COMPARED = ["model", "make", "year", "price", "mileage", "state"]


def with_tables(select: str) -> str:
    """Put the common tables a statement needs in front of it, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(select)
    if not needed:
        return select
    recursive = select.startswith("with recursive ")
    listed = ",\n".join(f"{n} as ({TABLES[n]})" for n in TABLES if n in needed)
    if recursive:
        return f"with recursive {listed},\n{select.removeprefix('with recursive ')}"
    return f"with {listed}\n{select}"


def missing_rows(table: str, columns) -> str:
    return " union all ".join(
        f"select '{c}' as attribute, count(*) - count({c}) as missing_count from {table}"
        for c in columns)


def distinct_rows(table: str, columns) -> str:
    return " union all ".join(
        f"select '{c}' as attribute, count(distinct {c}) as unique_count from {table}"
        for c in columns)


def summary_rows(table: str, columns, counted=None) -> str:
    return " union all ".join(
        f"select '{c}' as attribute, count(*) - count({c}) as missing_count, "
        + (f"count(distinct {c})" if counted is None or c in counted else "cast(null as bigint)")
        + f" as unique_count from {table}" for c in columns)


def stats_row(table: str, name: str, value: str) -> str:
    return (f"select '{name}' as attribute, count(x) as count, "
            "round(coalesce(avg(x), 0.0), 4) as mean, "
            "round(coalesce(stddev_samp(x), 0.0), 4) as std, round(min(x), 4) as min, "
            f"round(max(x), 4) as max from (select {value} as x from {table})")


def all_stats() -> str:
    rows = [stats_row("null_a", c, number(c) if c in A_COLUMNS else "cast(null as double)")
            for c in PROFILED_NUMERIC]
    return " union all ".join(rows)


def describe(table: str, columns) -> str:
    return " union all ".join(
        f"select '{c}' as attribute, count(x) as count, round(avg(x), 4) as mean, "
        "round(stddev_samp(x), 4) as std, round(min(x), 4) as min, round(max(x), 4) as max, "
        "round(quantile_cont(x, 0.25), 4) as q25, round(quantile_cont(x, 0.5), 4) as q50, "
        f"round(quantile_cont(x, 0.75), 4) as q75 from (select cast({c} as double) as x from {table})"
        for c in columns)


def records(texts=None) -> str:
    """The records behind the first pair table, one per source and id."""
    def side(s: str) -> str:
        return (f"select '{s}' as source, {side_list(s, NO_VIN)}, "
                f"row_number() over (partition by id_{s} order by id_A {{0}}, id_B {{0}}) as r from gt1")
    union = f"{side('A')} union all {side('B')}".replace("{0}", "desc" if texts else "asc")
    if not texts:
        return f"select * exclude (r) from ({union}) where r = 1"
    fixed = {"id", "price", "mileage"}
    columns = ", ".join(c if c in fixed else f"{norm_linker(f'cast({c} as varchar)')} as {c}"
                        for c in NO_VIN)
    return f"select source, {columns} from ({union}) where r = 1"


def profile_tables() -> str:
    """Profiles of the linker records with the keys of the two candidate rules."""
    def step(c: str) -> str:
        return f"case when {c} > 0 then floor(log10({c}) * 10) end"
    return f"""select source, {', '.join(COMPARED)}, count(*) as copies, {step('price')} as price_log,
        {step('mileage')} as mileage_log, substr(model, 1, 3) as model_first3,
        round(mileage) as mileage_whole from ({records(texts=True)}) group by all"""


TABLES["profiles"] = profile_tables()
RULE_KEYS = [["model", "price_log", "mileage_log"], ["model_first3", "year", "mileage_whole"]]


def met(i: int) -> str:
    return " and ".join(f"a.{k} = b.{k}" for k in RULE_KEYS[i])


def cost(i: int) -> str:
    keys = ", ".join(RULE_KEYS[i])
    whole = " and ".join(f"{k} is not null" for k in RULE_KEYS[i])
    return f"""select {i} as rule, cast(sum(a * b) as bigint) as pairs,
        cast(max(a * b) as bigint) as largest from (select count(*) filter (source = 'A') as a,
        count(*) filter (source = 'B') as b from profiles where {whole} group by {keys})"""


def candidate_rows() -> str:
    columns = ", ".join(f"{s}.{c} as {c}_{s}" for c in COMPARED for s in ("A", "B"))
    sides = "(select * from profiles where source = 'A') a join " \
            "(select * from profiles where source = 'B') b"
    return (f"select {columns} from {sides} on {met(0)} union all "
            f"select {columns} from {sides} on {met(1)} where not coalesce({met(0)}, false)")


def rates(tables: str) -> str:
    """Rates from a table of ``tp, fp, fn``."""
    return f"""select tp, fp, fn, round(p, 4) as precision, round(r, 4) as recall,
        round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 4) as f1 from (
        select *, case when tp + fp > 0 then tp / (tp + fp) else 0 end as p,
        case when tp + fn > 0 then tp / (tp + fn) else 0 end as r from ({tables}))"""


def on_texts(function) -> dict[str, str]:
    return {"": f"select doc_id, {function('text')} as normal from documents",
            "_pages": f"select page_id, {function('url')} as url, {function('html')} as html from pages"}


def capped(table: str, order: str) -> str:
    return (f"select * exclude (pos_a, rank_b) from (select * from {table} "
            f"order by pos_a, {order} limit {CAP})")


_med = ", ".join(NAMES)


def log_distance(c: str) -> str:
    return (f"case when {c}_A > 0 and {c}_B > 0 then "
            f"abs(log10({c}_A) - log10({c}_B)) end")


def role_of() -> str:
    return f"""select *, case when unique_count = 0 then 'empty'
        when unique_count / (select count(*) from med_b) >= 0.9 then 'identifier'
        when unique_count / (select count(*) from med_b) <= 0.01 then 'categorical'
        else 'approximate' end as role from ({summary_rows('med_b', NAMES)})"""


def merged(c: str) -> str:
    return (f"select '{c}' as attribute, cast(count(*) - count({c}) as bigint) as missing_count, "
            f"count({c}) as count, round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as std, "
            f"round(min({c})::double, 3) as min, round(max({c})::double, 3) as max, "
            "true as within_bound from orders")


def best_of_both(table: str, *within: str) -> str:
    """``table`` with ``best``: whether a pair is the best of both its sides."""
    ranks = [f"row_number() over (partition by {', '.join([*within, side])} order by score desc, tie desc) = 1"
             for side in ("id_A", "id_B")]
    return f"(select *, {' and '.join(ranks)} as best from {table})"


# Rounds of mutually best pairs: a round's open pairs are those of which the last round used neither side.
ONE_TO_ONE = f"""with recursive open_pairs(id_A, id_B, score, tie, turn) as (
    select id_A, id_B, round(score, 6), {digest('id_A', 'id_B')}, 1 from scored where prediction = 1
    union all
    select id_A, id_B, score, tie, turn + 1 from (
        select *, bool_or(best) over (partition by id_A) as used_a,
               bool_or(best) over (partition by id_B) as used_b from {best_of_both('open_pairs')})
    where not used_a and not used_b)
select id_A, id_B, score from {best_of_both('open_pairs', 'turn')} where best"""

TEXT_FIELDS = ("model", "make", "year", "state")
# Cheapest alignments of distinct pairs of texts, one character of the first text a step. ``ends`` has the
# cost of each prefix of the second text, ``gaps`` that of ending in a gap there. A gap in the other text that ends at j
# began after some k < j, so it is a minimum over k.
def distances(texts: str, far: str = "far") -> str:
    """Recursive tables that end in ``far(a, b, d)``: distances of all distinct pairs of texts in ``texts``."""
    return f"""distinct_{far} as ({' union '.join(
    f'select {f}_A as a, {f}_B as b from {texts} where {f}_A <> {f}_B' for f in TEXT_FIELDS)}),
aligned_{far}(a, b, i, ends, gaps) as (
    select a, b, 0, list_transform(range(0, length(b) + 1), lambda j: case when j = 0 then 0.0 else 10 + 7.0 * j end),
           list_transform(range(0, length(b) + 1), lambda j: 1e18) from distinct_{far}
    union all
    select a, b, i, list_transform(range(1, length(b) + 2), lambda j: case when j = 1 then base[1] else
               least(base[j], 7 * j + 10 + list_min(list_transform(range(1, j), lambda k: base[k] - 7 * k))) end), gaps
    from (select a, b, i, gaps, list_transform(range(1, length(b) + 2), lambda j: case when j = 1 then gaps[1] else
               least(gaps[j], ends[j - 1] + case when substr(b, j - 1, 1) = substr(a, i, 1) then 1 else 11 end) end) as base
          from (select a, b, i + 1 as i, ends, list_transform(range(1, length(b) + 2), lambda j:
                    least(ends[j] + 10, gaps[j]) + 7) as gaps from aligned_{far} where i < length(a)))),
{far} as (select a, b, ends[length(b) + 1] / (length(a) + length(b)) as d from aligned_{far} where i = length(a))"""


def with_distances(texts: str, far: str = "far") -> tuple[str, str]:
    """The distances of the text fields as columns (null where a side is missing), and the joins they need."""
    columns = ", ".join(f"case when {f}_A = {f}_B then 0.5 else {f}_far.d end as {f}" for f in TEXT_FIELDS)
    joins = " ".join(f"left join {far} {f}_far on {f}_far.a = {f}_A and {f}_far.b = {f}_B" for f in TEXT_FIELDS)
    return columns, f"{texts} {joins}"


COLUMNS, JOINED = with_distances("linked_texts")
DISTANCES = f"""with recursive {distances('linked_texts')}
select id_A, id_B, {', '.join(f'coalesce({f}, 0.0) as {f}' for f in TEXT_FIELDS)}
from (select id_A, id_B, {COLUMNS} from {JOINED})"""


def newton(vectors: str, features, steps: int = 30, penalty: float = 1.0) -> str:
    """Recursive tables that end in ``weights(w)``: logistic regression by Newton steps.

    ``vectors`` gives the features, ``y`` and a count ``n``. The intercept, last, has no
    penalty. Each step solves its linear system by elimination on a list of rows.
    """
    x = [*features, "1.0"]
    size = len(x)
    z = " + ".join(f"w[{i + 1}] * {c}" for i, c in enumerate(x))
    held = [f"{penalty} * w[{i + 1}]" if i < size - 1 else "0" for i in range(size)]
    rows = ["[" + ", ".join([*(f"sum(n * p * (1 - p) * {a} * {b})" + (f" + {penalty}" if i == j < size - 1 else "")
                              for j, b in enumerate(x)), f"sum(n * (p - y) * {a}) + {held[i]}"]) + "]"
            for i, a in enumerate(x)]
    steps_of = ", ".join(f"[[{k + 1}.0]]" for k in range(size))
    eliminate = ("lambda m, k: list_transform(m, lambda r, i: list_transform(r, lambda v, j: case when i = k[1][1] then "
                 "v / m[k[1][1]::int][k[1][1]::int] else v - r[k[1][1]::int] / m[k[1][1]::int][k[1][1]::int] * "
                 "m[k[1][1]::int][j] end))")
    return f"""vectors as ({vectors}),
fits(step, w) as (
    select 0, [{', '.join(['0.0::double'] * size)}]
    union all
    select step + 1, list_transform(w, lambda v, i: v - solved[i][{size + 1}]) from (
        select step, w, list_reduce([system, {steps_of}], {eliminate}) as solved from (
            select step, w, [{', '.join(rows)}] as system
            from (select *, 1 / (1 + exp(-({z}))) as p from fits, vectors where step < {steps}) group by step, w))),
weights as (select w from fits where step = {steps})"""


FEATURES = ("model", "year", "mileage", "state", "make")
FITTED = " + ".join([*(f"w[{i + 1}] * f.{c}" for i, c in enumerate(FEATURES)), f"w[{len(FEATURES) + 1}]"])
FIT_PREDICT = f"""with recursive split_feat as (select f.*, s.split from feat f join split_b1 s
    on s.id_A = f.id_A and s.id_B = f.id_B and s.label = f.label),
{newton(f"select {', '.join(FEATURES)}, label as y, count(*) as n from split_feat where split = 'train' group by all",
        FEATURES)}
select id_A, id_B, label, cast(1 / (1 + exp(-({FITTED}))) >= 0.5 as integer) as prediction,
       round(1 / (1 + exp(-({FITTED}))), 3) as score
from split_feat f, weights where split = 'test'"""


LINKER_FIELDS = [*TEXT_FIELDS[:3], "price", "mileage", "state"]
MISSABLE = ["year", "price", "mileage", "state"]
LINKER = [*LINKER_FIELDS, *[f"{c}_missing" for c in MISSABLE]]
EXAMPLE_COLUMNS, EXAMPLES = with_distances("example_texts")
LINKER_FITTED = " + ".join([*(f"w[{i + 1}] * {c}" for i, c in enumerate(LINKER)), f"w[{len(LINKER) + 1}]"])
LINKER_TABLES = f"""{distances('example_texts')},
measured as (select id_A, id_B, label, {EXAMPLE_COLUMNS}, {log_distance('price')} as price,
    {log_distance('mileage')} as mileage from {EXAMPLES}),
examples as (select id_A, id_B, label, {', '.join(f'coalesce({c}, 0.0) as {c}' for c in LINKER_FIELDS)},
    {', '.join(f'cast({c} is null as double) as {c}_missing' for c in MISSABLE)} from measured),
{newton(f"select {', '.join(LINKER)}, label as y, count(*) as n from examples group by all", LINKER)}"""
LINKER_FIT = f"""with recursive {LINKER_TABLES}
select id_A, id_B, label, cast(1 / (1 + exp(-({LINKER_FITTED}))) >= 0.5 as integer) as prediction,
       round(1 / (1 + exp(-({LINKER_FITTED}))), 2) as score
from examples, weights"""


def soundex(c: str) -> str:
    """First letter and three digits; h and w are passed over, vowels and other signs part equal digits."""
    upper = f"upper({c})"
    codes = (f"translate(regexp_replace({upper}, '[^A-Z]', '0', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'01230127022455012623017202')")
    rest = f"case when {codes}[1] = '7' then '0' else {codes}[1] end || replace({codes}[2:], '7', '')"
    for digit in "123456":
        rest = f"regexp_replace({rest}, '{digit}+', '{digit}', 'g')"
    return (f"case when regexp_matches({upper}, '^[A-Z]') then {upper}[1] || "
            f"rpad(replace(({rest})[2:], '0', '')[1:3], 3, '0') else {c} end")


def text_keys(c: str) -> dict[str, str]:
    return {f"{c}_whole": c, f"{c}_first3": f"substr({c}, 1, 3)", f"{c}_first5": f"substr({c}, 1, 5)",
            f"{c}_token": f"split_part({c}, ' ', 1)", f"{c}_sound": soundex(c)}


PREDICATES = {**text_keys("model"), **text_keys("make"), "year_whole": "year", "state_whole": "state"}
for _c in ("price", "mileage"):
    PREDICATES[f"{_c}_log"] = f"cast(case when {_c} > 0 then floor(log10({_c}) * 10) end as varchar)"
    PREDICATES[f"{_c}_whole"] = f"cast(round({_c}) as varchar)"
TABLES["train_pairs"] = "select g.* from gt1 g join train t on t.id_A = g.id_A and t.id_B = g.id_B and t.label = g.label"
_N = len(PREDICATES)
# Matches by the predicates they agree in, rules of one to three of them, pairs that each brings together, and the
# greedy choice by newly covered matches per pair.
BLOCK_TABLES = f"""keyed as (select source, id, [{', '.join(PREDICATES.values())}] as keys
    from ({records(texts=True).replace('from gt1', 'from train_pairs')})),
signatures as (select s, count(*) as n, row_number() over (order by s) as sig from (
    select list_filter(range(1, {_N + 1}), lambda i: a.keys[i] = b.keys[i]) as s from links l
    join keyed a on a.source = 'A' and a.id = l.id_A join keyed b on b.source = 'B' and b.id = l.id_B) group by s),
one as (select range as i from range(1, {_N + 1})),
rules as (select [i] as terms from one union all select [a.i, b.i] from one a join one b on a.i < b.i union all
    select [a.i, b.i, c.i] from one a join one b on a.i < b.i join one c on b.i < c.i),
covers as (select terms, list(sig order by sig) as cover from rules join signatures on list_has_all(s, terms) group by terms),
useful as (select *, array_to_string(list_transform(terms, lambda t: [{', '.join(f"'{p}'" for p in PREDICATES)}][t]), ' & ')
    as name from covers c where not exists (select 1 from covers o where o.cover = c.cover
    and len(o.terms) > len(c.terms) and list_has_all(o.terms, c.terms))),
blocks as (select terms, block, count(*) filter (source = 'A') as a, count(*) filter (source = 'B') as b from (
    select terms, source, list_transform(terms, lambda t: keys[t]) as block from useful, keyed)
    where len(list_filter(block, lambda x: x is null)) = 0 group by terms, block),
costs as (select u.*, coalesce(p.pairs, 0.0) as pairs from useful u
    left join (select terms, sum(a::double * b) as pairs from blocks group by terms) p on p.terms = u.terms),
chosen(position, rule, newly_covered, pairs, rest) as (
    select 0, '', 0::bigint, 0.0::double, (select list(sig order by sig) from signatures)
    union all
    select position + 1, name, gain::bigint, pairs_of, list_filter(rest, lambda x: not list_contains(cover, x)) from (
        select *, row_number() over (order by gain / coalesce(nullif(pairs_of, 0), least_pairs) desc, gain desc, name desc) as r
        from (select h.position, h.rest, u.name, u.cover, u.pairs as pairs_of,
                     (select min(pairs) from costs where pairs > 0) as least_pairs,
                     list_sum(list_transform(list_intersect(u.cover, h.rest), lambda x: c.counts[x])) as gain
              from chosen h, costs u, (select list(n order by sig) as counts from signatures) c)
        where gain > 0) where r = 1)"""
BLOCK_LEARN = f"""with recursive {BLOCK_TABLES}
select position, rule, newly_covered, pairs from chosen where position > 0"""


def json_of(columns) -> str:
    """The row as Spark writes it: fields without a value are left out."""
    parts = ", ".join(
        f"""'"{c}":' || """ + (f"cast({c} as varchar)" if c in ("price", "mileage") else f"""'"' || {c} || '"'""")
        for c in columns)
    return f"""'{{' || array_to_string(list_filter([{parts}], lambda x: x is not null), ',') || '}}'"""


TABLES["test_pairs"] = """select g.* from gt1 g join split_b1 s on s.id_A = g.id_A and s.id_B = g.id_B
    and s.label = g.label where s.split = 'test'"""
FAR_COLUMNS, FAR_JOINED = with_distances("met_texts", "far_met")
# The whole linker: rules and weights learned above, profiles of the test records, pairs of profiles that meet under a
# rule, their scores, the greedy assignment with copies, and the records behind the copies' numbers.
LINK_JOIN = f"""with recursive {LINKER_TABLES},
{BLOCK_TABLES},
test_records as (select *, sha256({json_of(COMPARED)}) as profile
    from ({records(texts=True).replace('from gt1', 'from test_pairs')})),
test_profiles as (select source, profile, {', '.join(f'min({c}) as {c}' for c in COMPARED)}, count(*) as copies
    from test_records group by source, profile),
test_keys as (select *, [{', '.join(PREDICATES.values())}] as keys from test_profiles),
filed as (select source, profile, name, list_transform(terms, lambda t: keys[t]) as block
    from test_keys, (select distinct terms, name from useful where name in (select rule from chosen where position > 0))),
met_texts as (select distinct a.profile as id_A, b.profile as id_B from filed a join filed b on a.source = 'A'
    and b.source = 'B' and a.name = b.name and a.block = b.block
    where len(list_filter(a.block, lambda x: x is null)) = 0),
met_rows as (select m.id_A, m.id_B, a.copies as copies_A, b.copies as copies_B, {', '.join(
        f'{s.lower()}.{c} as {c}_{s}' for c in COMPARED for s in ('A', 'B'))} from met_texts m
    join test_profiles a on a.source = 'A' and a.profile = m.id_A
    join test_profiles b on b.source = 'B' and b.profile = m.id_B),
{distances('met_rows', 'far_met')},
met_far as (select id_A, id_B, copies_A, copies_B, {FAR_COLUMNS}, {log_distance('price')} as price,
    {log_distance('mileage')} as mileage from {FAR_JOINED.replace('met_texts', 'met_rows', 1)}),
met_features as (select id_A, id_B, copies_A, copies_B, {', '.join(f'coalesce({c}, 0.0) as {c}' for c in LINKER_FIELDS)},
    {', '.join(f'cast({c} is null as double) as {c}_missing' for c in MISSABLE)} from met_far),
open_pairs(id_A, id_B, score, tie, copies_A, copies_B, from_A, from_B, turn) as (
    select id_A, id_B, score, {digest('id_A', 'id_B')}, copies_A, copies_B, 0::bigint, 0::bigint, 1
    from (select *, 1 / (1 + exp(-({LINKER_FITTED}))) as score from met_features, weights) where score >= 0.5
    union all
    select id_A, id_B, score, tie, copies_A, copies_B, from_A + used_a, from_B + used_b, turn + 1 from (
        select *, sum(case when best then least(copies_A - from_A, copies_B - from_B) else 0 end)
                      over (partition by id_A)::bigint as used_a,
               sum(case when best then least(copies_A - from_A, copies_B - from_B) else 0 end)
                      over (partition by id_B)::bigint as used_b from {best_of_both('open_pairs')})
    where from_A + used_a < copies_A and from_B + used_b < copies_B),
taken as (select *, least(copies_A - from_A, copies_B - from_B) as take from {best_of_both('open_pairs', 'turn')} where best),
numbers as (select id_A as profile_A, id_B as profile_B, score, from_A + place as number_A, from_B + place as number_B
    from (select *, unnest(range(1, take + 1)) as place from taken)),
numbered as (select source, profile, id, row_number() over (partition by source, profile order by {digest('id')}, id) as number
    from test_records)
select a.id as id_A, b.id as id_B, round(score, 2) as score from numbers n
join numbered a on a.source = 'A' and a.profile = profile_A and a.number = number_A
join numbered b on b.source = 'B' and b.profile = profile_B and b.number = number_B"""


STATEMENTS: dict[str, str] = {
    "scan_text_na": f"select {', '.join(B_COLUMNS)} from null_b",
    "scan_quoted": f"select {', '.join(B_COLUMNS)} from (select * replace ("
                   "description || chr(10) || 'second line, of ' || id as description) from null_b)",
    "scan_typed": "select * from orders",
    "scan_inferred": "select o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority from orders",
    "describe_nan": describe("(select case when o_orderkey % 7 = 0 then null else o_totalprice end as price "
                             "from orders)", ["price"]),
    "prepared_counts": """select strategy, split, label, count(*) as n,
        cast(count(*) filter (price_A is null or price_B is null) as bigint) as without_price from (
        select 'b1' as strategy, id_A, id_B, label, split, price_A, price_B from split_b1 join gt1 using (id_A, id_B, label)
        union all select 'b2', id_A, id_B, label, split, price_A, price_B from split_b2 join gt2 using (id_A, id_B, label))
        group by all""",
    "prepared_splits": "select id_A, id_B, label, split, 'b1' as strategy from split_b1 union all "
                       "select id_A, id_B, label, split, 'b2' from split_b2",
    "sink_roundtrip": f"select {_med} from med_b",
    "sink_partitioned": "select 'b2' as strategy, split, label, count(*) as n from split_b2 group by all",
    "mediate_a": f"select {_med} from med_a",
    "mediate_b": f"select {_med} from med_b",
    "mediate_absent": "select * exclude (pos) replace (cast(null as double) as price, "
                      "cast(null as varchar) as fuel, cast(null as varchar) as description) from med_a",
    "drop_leakage": "select * exclude (VIN) from null_b",
    "preview": f"select {_med} from med_b order by pos, id limit 10",
    "to_numeric": f"select id, {number('price')} as price, {number('year')} as year, "
                  f"{number('model')} as model from raw_b",
    **{f"norm_block{k}": v for k, v in on_texts(norm_block).items()},
    **{f"norm_compare{k}": v for k, v in on_texts(norm_compare).items()},
    **{f"norm_linker{k}": v for k, v in on_texts(norm_linker).items()},
    "clean_key17": f"select id, {clean_vin('VIN')} as vin_clean from raw_b",
    "mileage_bin": f"select listing_id, {bin_of(number('mileage'))} as bin, "
                   f"{bin_of(number('horsepower'))} as power_bin from raw_a",
    "block_key_b1": f"""select id, {block_text('make')} as block_make,
        {block_text('model')} as block_model,
        {block_text('make')} || '|' || {block_text('model')} as block from med_b""",
    "block_key_b2": f"""select id, {block_text('make')} as block_make,
        {block_text('model')} as block_model, year as block_year,
        {bin_of('mileage')} as block_mileage_bin,
        {block_text('make')} || '|' || {block_text('model')} || '|'
        || coalesce(cast(year as varchar), 'nan') || '|'
        || coalesce(cast({bin_of('mileage')} as varchar), 'nan') as block from med_b""",
    "block_text_drop": f"select id, {norm_block('make')} as make, {norm_block('model')} as model from med_a",
    "gt_b1": "select * from gt1",
    "gt_b2": "select * from gt2",
    "gt_capped": f"{capped('pos_pairs', 'id_A, rank_b')} union all {capped('neg_b1', 'id_A, rank_b')}",
    "gt_positives": "select id_A, id_B, vin_A as vin from pos_pairs",
    "gt_negatives": "select id_A, id_B, vin_A, vin_B from neg_b2",
    "gt_drop_missing": f"""select id_A, id_B, label from pos_pairs union all
        select a.id, b.id, 0 from (select *, {norm_block('make')} as n1,
          {norm_block('model')} as n2 from vin_a) a
        join (select *, row_number() over (partition by n1, n2 order by pos, id) as r from (
          select *, {norm_block('make')} as n1, {norm_block('model')} as n2 from vin_b)
          where n1 is not null and n2 is not null) b
        on a.n1 = b.n1 and a.n2 = b.n2 where r <= 5 and a.vin <> b.vin""",
    "topk_block": f"""select block_make, id, r as block_rank from (select *,
        row_number() over (partition by block_make order by pos, id) as r
        from (select *, {block_text('make')} as block_make from med_b)) where r <= 5""",
    "dedup_vin_first": "select id, vin as vin_clean, price, mileage from vin_a",
    "dedup_vin_last": "select id, vin as vin_clean, price, mileage from vin_b",
    "upsert_chunks": "select id, vin as vin_clean, price, mileage from vin_b",
    "records_from_pairs": records(),
    "records_for_linker": records(texts=True),
    "label_sample": """select id_A, id_B, label, model_A from (select *,
        row_number() over (partition by label order by id_A, id_B) as r from gt1) where r <= 10""",
    "semi_ids": "select id, make, model from med_a where id in (select id_A from known)",
    "anti_pairs": """select distinct id_A, id_B from gt1 g where not exists (
        select 1 from gt2 h where h.id_A = g.id_A and h.id_B = g.id_B)""",
    "profile_missing": missing_rows("null_a", A_COLUMNS),
    "profile_distinct": distinct_rows("null_a", A_COLUMNS),
    "profile_summary": summary_rows("null_a", A_COLUMNS, PROFILED_DISTINCT),
    "profile_top": f"select * from ({missing_rows('null_b', B_COLUMNS)}) "
                   "order by missing_count desc, attribute limit 50",
    "profile_approx": f"select *, true as within_bound from ({summary_rows('med_b', NAMES)})",
    "profile_states": " union all ".join(
        f"select * exclude (within_bound) from ({merged(c)})" for c in ("o_custkey", "o_totalprice")),
    "profile_merge": f"{merged('o_custkey')} union all {merged('o_totalprice')}",
    "numeric_stats": all_stats(),
    "describe_numeric": describe("lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax"]),
    "table_shape": f"select count(*) as rows, {len(B_COLUMNS) + 1} as columns from raw_b",
    "attribute_roles": role_of(),
    "constant_columns": " union all ".join(
        f"select '{c}' as attribute, min({c}) is not distinct from max({c}) as constant from med_a"
        for c in NAMES),
    "split_stratified": "select * from split_b1",
    "split_sizes": "select 'b1' as strategy, split, label, count(*) as n from split_b1 group by all "
                   "union all select 'b2', split, label, count(*) from split_b2 group by all",
    "sample_extras": "select * from sample_a",
    "sample_negatives": "select * from negatives",
    "training_pairs": f"""select p.*, {', '.join(
        f'{norm_linker(f"{s}.{c}")} as {c}_{s}' for c in ('model', 'make') for s in ('A', 'B'))},
        A.price as price_A, B.price as price_B from (
        select id_A, id_B, 1 as label from links union all
        select id_A, id_B, 0 from negatives) p
        join med_a A on A.id = id_A join med_b B on B.id = id_B""",
    "jw_threshold": f"""select id_A, id_B,
        {jaro_winkler(norm_compare('model_A'), norm_compare('model_B'), 0.9)} as model,
        {jaro_winkler(norm_compare('model_A'), norm_compare('description_B'), 0.7)} as described
        from gt1""",
    "sim_linear_year": f"select id_A, id_B, round({linear('year_A', 'year_B', 5)}, 6) as year from gt1",
    "sim_linear_bin": f"""select id_A, id_B,
        round({linear(bin_of('mileage_A'), bin_of('mileage_B'), 2)}, 6) as mileage,
        round({linear('price_A', 'price_B', 3, 1.5)}, 6) as price from gt1""",
    "sim_exact": f"""select id_A, id_B, {exact('state_A', 'state_B')} as state,
        {exact(norm_compare('make_A'), norm_compare('make_B'))} as make,
        {exact('body_type_A', 'body_type_B')} as body_type from gt1""",
    "pair_features": "select * replace (round(year, 4) as year, round(mileage, 4) as mileage) from feat",
    "lr_score_fixed": "select id_A, id_B, label, prediction, round(score, 6) as score from scored",
    "confusion": """select l.v as label, p.v as prediction, count(s.id_A) as n
        from (values (0), (1)) l(v) cross join (values (0), (1)) p(v)
        left join scored s on s.label = l.v and s.prediction = p.v group by all""",
    "metrics_pairs": rates("""select count(*) filter (label = 1 and prediction = 1) as tp,
        count(*) filter (label = 0 and prediction = 1) as fp,
        count(*) filter (label = 1 and prediction = 0) as fn from scored"""),
    "metrics_links": rates("""select
        (select count(*) from (select * from known intersect select * from predicted)) as tp,
        (select count(*) from (select * from predicted except select * from known)) as fp,
        (select count(*) from (select * from known except select * from predicted)) as fn"""),
    "links_intersect": "select * from known intersect select * from predicted",
    "links_except": """select *, 'false_positive' as kind from (
        select * from predicted except select * from known) union all
        select *, 'false_negative' from (select * from known except select * from predicted)""",
    "links_distinct": "select id_A, id_B from gt1 union select id_A, id_B from gt2",
    "linker_features": f"""select id_A, id_B, label,
        round(coalesce({log_distance('price')}, 0.0), 4) as price,
        round(coalesce({log_distance('mileage')}, 0.0), 4) as mileage,
        cast(year_A is null or year_B is null as double) as year_missing,
        cast({log_distance('price')} is null as double) as price_missing,
        cast({log_distance('mileage')} is null as double) as mileage_missing,
        cast(state_A is null or state_B is null as double) as state_missing from linked_texts""",
    "candidates": candidate_rows(),
    "linker_distances": DISTANCES,
    "linker_fit": LINKER_FIT,
    "lr_fit_predict": FIT_PREDICT,
    "one_to_one": ONE_TO_ONE,
    "block_learn": BLOCK_LEARN,
    "link_join": LINK_JOIN,
    "block_costs": f"{cost(0)} union all {cost(1)}",
    "profile_copies": f"select source, copies, {', '.join(COMPARED)} from profiles",
    "one_to_one_round1": f"""select id_A, id_B, score from (
        select *, row_number() over (partition by id_A order by score desc, tie desc) as ra,
        row_number() over (partition by id_B order by score desc, tie desc) as rb from (
        select id_A, id_B, round(score, 6) as score, {digest('id_A', 'id_B')} as tie
        from scored where prediction = 1)) where ra = 1 and rb = 1""",
}

ORACLE: dict[str, str] = {name: with_tables(sql) for name, sql in STATEMENTS.items()}
