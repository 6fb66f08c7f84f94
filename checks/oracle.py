"""SQL twins of the queries, for DuckDB on the same tables."""

from __future__ import annotations

from checks.queries import DEAR, FLAGS, FOLD_SEED, HOLDOUT_SEED, MIXED, STRATIFIED_SEED
from retourlens.operators.features import Support

SALES = """
sales as (
  select
    row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
      l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) + 100 * l_orderkey as order_item_id,
    o_orderkey % 3 = 0 as is_unknown,
    cast(o_orderdate as date) as order_date,
    case when l_tax = 0 then null else cast(l_shipdate as date) end as delivery_date,
    l_partkey as item_id,
    case l_partkey % 7
      when 0 then cast(36 + l_linenumber as varchar)
        || case when cast(l_quantity as int) % 2 = 1 then '+' else '' end
      when 1 then ['XS','s','M','l','XL','xxl','XXXL'][l_linenumber]
      when 2 then cast(2 * l_linenumber as varchar)
      when 3 then cast(3000 + 32 * l_linenumber as varchar)
      when 4 then cast(86 + 6 * l_linenumber as varchar)
      when 5 then cast(30 + l_linenumber as varchar)
      else 'unsized' end as item_size,
    ['blau','brwon','oliv','blue','brown','olive','black','?'][l_suppkey % 8 + 1] as item_color,
    cast(replace(p_brand, 'Brand#', '') as bigint) as brand_id,
    l_extendedprice / 1000 as item_price,
    o_custkey as user_id,
    case when c_custkey % 11 = 0 then null
      else date '1940-01-01' + cast((c_custkey * 37) % 18000 as int) end as user_dob,
    date '1994-06-01' + cast((c_custkey * 13) % 900 as int) as user_reg_date,
    case when o_orderkey % 3 = 0 then null else cast(l_returnflag = 'R' as int) end as returned
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join part on l_partkey = p_partkey
)"""

REKEYED = """
sales as (
  select * replace (
    case when is_unknown then item_id * 2 + 2 else item_id end as item_id,
    case when is_unknown then brand_id + 100 else brand_id end as brand_id)
  from raw_sales
)"""

PRICED = "priced as (select * replace (round_even(item_price, 0) as item_price) from sales)"
COLOURED = """coloured as (select * replace (case item_color when 'blau' then 'blue'
  when 'brwon' then 'brown' when 'oliv' then 'olive' else item_color end as item_color) from sales)"""
SIZED = "sized as (select * replace (replace(lower(item_size), '+', '.5') as item_size) from sales)"
NUMBERED = """numbered as (select * replace (cast(case item_size when 'unsized' then '0'
  when 'xs' then '1' when 's' then '2' when 'm' then '3' when 'l' then '4' when 'xl' then '5'
  when 'xxl' then '6' when 'xxxl' then '7' else item_size end as double) as item_size) from sized)"""
TYPED = """kinds as (
  select item_id, case
    when bool_or(contains(item_size, '.5')) then 1
    when bool_and(regexp_full_match(item_size, '[0-9]+')) then case
      when min(try_cast(item_size as double)) < 15 and max(try_cast(item_size as double)) < 25 then 3
      when min(try_cast(item_size as double)) > 2000 then 4
      when min(try_cast(item_size as double)) > 80 and max(try_cast(item_size as double)) < 200 then 5
      else 6 end
    when bool_and(item_size = 'unsized') then 7
    else 2 end as type
  from sized group by item_id
)"""
SCALED = """middle as (select item_id, median(item_size) as mid from numbered group by item_id),
spread as (
  select item_id, any_value(mid) as mid, median(abs(item_size - mid)) / 0.6744897501960817e0 as mad
  from numbered join middle using (item_id) group by item_id
),
scaled as (
  select order_item_id, case when mad = 0 then 0e0
    else round_even((item_size - mid) / mad * 100, 0) / 100 + 0e0 end as item_size
  from numbered join spread using (item_id)
)"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join([SALES, *parts]) + "\n"


def _rate(source: str, keys: list[str], name: str, min_count: int, steps: bool) -> str:
    """CTE ``name``: order_item_id and the smoothed rate of its key."""
    key = ", ".join(keys)
    ratio = "sum(returned) * 1e0 / count(*)"
    if steps:
        ratio = f"round_even({ratio} * 1000, 0) / 1000"
    return f"""{name}_by_key as (
  select {key}, case when count(*) < {min_count} then 0.48e0 else {ratio} end as rate
  from {source} where not is_unknown group by {key}
),
{name} as (
  select order_item_id, round_even(coalesce(rate, 0.48e0) * 100, 0) / 100 as {name}
  from {source} left join {name}_by_key using ({key})
)"""


def _brand(s, source="sales"):
    return _rate(source, ["brand_id"], "ce_brand", s.brand, True)


def _item(s, source="sales"):
    return _rate(source, ["item_id"], "ce_item", s.item, True)


def _user(s=Support(), source="sales"):
    return _rate(source, ["user_id"], "ce_user", s.user, True)


def _price(s, source="priced"):
    return _rate(source, ["item_price"], "ce_price", s.price, True)


def _colour(s):
    return _rate("coloured", ["item_id", "item_color"], "colour_item_ce", s.pair, False)


def _size(s):
    return _rate("sized", ["item_id", "item_size"], "size_item_ce", s.pair, False)


def _pick(cte: str) -> str:
    return f"select order_item_id, {cte} from {cte}"


def _encoders() -> dict[str, str]:
    made = {}
    for suffix, s in (("", Support()), ("_mixed", MIXED)):
        made[f"ce_brand{suffix}"] = _with(_brand(s)) + _pick("ce_brand")
        made[f"ce_item{suffix}"] = _with(_item(s)) + _pick("ce_item")
        made[f"ce_user{suffix}"] = _with(_user(s)) + _pick("ce_user")
        made[f"ce_price{suffix}"] = _with(PRICED, _price(s)) + _pick("ce_price")
        made[f"colour_item_ce{suffix}"] = _with(COLOURED, _colour(s)) + _pick("colour_item_ce")
        made[f"size_item_ce{suffix}"] = _with(SIZED, _size(s)) + _pick("size_item_ce")
    return made


DISCOUNTED = """cast(avg(item_price) over (partition by item_id) - item_price > 0 as int)
  as is_discounted"""
EARLIER = """cast(coalesce(date_diff('day', max(order_date) over (partition by {keys} order by order_date
  range between unbounded preceding and interval 1 day preceding), order_date), {default}) as int)"""
LATEST = EARLIER.format(keys="user_id", default=-1) + " as latest_order"
RECENT = EARLIER.format(keys="user_id, item_id", default=0) + " as ordered_item_recently"
MEMBER = """cast(case when date_diff('day', user_reg_date, order_date) = -1 then 0
  else date_diff('day', user_reg_date, order_date) end as int) as membership_age_days"""
DELIVERY = """cast(coalesce(case when date_diff('day', order_date, delivery_date) < 0 then -1
  else date_diff('day', order_date, delivery_date) end, 9999) as int) as time_to_delivery_days"""
AGE = "round_even(coalesce(date_diff('day', user_dob, order_date) / 365e0, 0), 0) as assumed_age"
DELIVERED = "cast(delivery_date is not null as int) as was_delivered"
PER_DAY = "count(*) over (partition by user_id, order_date) as orders_per_day"
MULTI = "count(*) over (partition by user_id, item_id, item_color) as multi_colour_per_day"
PAIR = "count(*) over (partition by user_id, item_id) as count_item_user"
VALUE = "sum(item_price) over (partition by user_id) as customer_value"
VISITS = "count(*) over (partition by user_id) as count_user"
NEWNESS = "cast(count(*) over (partition by user_id) <= 1 as int) as new_user"
DUMMIES = ", ".join(f"cast(type = {t} as int) as type_{t}" for t in range(1, 8))


def _on(source: str, expression: str, *parts: str) -> str:
    return _with(*parts) + f"select order_item_id, {expression} from {source}"


def _features() -> dict[str, str]:
    return {
        "is_discounted": _on("priced", DISCOUNTED, PRICED),
        "orders_per_day": _on("sales", PER_DAY),
        "multi_colour_per_day": _on("sales", MULTI),
        "colour_fix": _on("coloured", "item_color", COLOURED),
        "count_item_user": _on("sales", PAIR),
        "customer_value": _on("priced", VALUE, PRICED),
        "count_user_new_user": _on("sales", f"{VISITS}, {NEWNESS}"),
        "size_text": _on("sized", "item_size", SIZED),
        "item_type": _on("sized join kinds using (item_id)", "type", SIZED, TYPED),
        "type_dummies": _on("sized join kinds using (item_id)", DUMMIES, SIZED, TYPED),
        "size_numeric": _on("numbered", "item_size", SIZED, NUMBERED),
        "size_normalised": _on("scaled", "item_size", SIZED, NUMBERED, SCALED),
        "was_delivered": _on("sales", DELIVERED),
        "latest_order": _on("sales", LATEST),
        "ordered_item_recently": _on("sales", RECENT),
        "membership_age": _on("sales", MEMBER),
        "time_to_delivery": _on("sales", DELIVERY),
        "assumed_age": _on("sales", AGE),
    }


def _table(s: Support, rekeyed: bool = False) -> str:
    sales = [SALES.replace("sales as", "raw_sales as", 1), REKEYED] if rekeyed else [SALES]
    parts = [
        *sales, PRICED, COLOURED, SIZED, NUMBERED, TYPED, SCALED,
        _brand(s), _item(s), _user(s), _price(s), _colour(s), _size(s),
    ]
    rates = ["ce_brand", "ce_item", "ce_user", "ce_price", "colour_item_ce", "size_item_ce"]
    joins = "\n  ".join(f"join {r} using (order_item_id)" for r in rates)
    own = ", ".join(
        [DISCOUNTED, PER_DAY, MULTI, PAIR, VALUE, VISITS, NEWNESS, DELIVERED, LATEST, RECENT,
         MEMBER, DELIVERY, AGE]
    )
    return (
        "with "
        + ",\n".join(parts)
        + f""",
own as (
  select order_item_id, item_id, brand_id, user_id, is_unknown, returned, item_price, {own} from priced
)
select own.* , scaled.item_size, {", ".join(rates)}, {DUMMIES}
from own join scaled using (order_item_id) join kinds using (item_id)
  {joins}
"""
    )


def _gaps() -> str:
    """Values of groups where every eleventh row lacks its item, and so on."""
    lacking = "sales as (select * replace (" + ", ".join(
        f"case when order_item_id % {n} <> 0 then {c} end as {c}"
        for c, n in {"item_id": 11, "user_id": 13, "item_price": 5, "item_size": 7, "item_color": 17}.items()
    ) + ") from raw_sales)"
    parts = [
        SALES.replace("sales as", "raw_sales as", 1), lacking, PRICED, COLOURED, SIZED, TYPED,
        _item(MIXED), _user(MIXED), _colour(MIXED), _size(MIXED),
    ]
    dummies = ", ".join(f"cast(coalesce(type, 2) = {t} as int) as type_{t}" for t in range(1, 8))
    return (
        "with " + ",\n".join(parts) + f"""
select order_item_id,
  cast(coalesce(case when item_id is not null then avg(item_price) over (partition by item_id) end - item_price > 0, false)
    as int) as is_discounted,
  case when item_id is not null or is_unknown then ce_item end as ce_item,
  case when user_id is not null or is_unknown then ce_user end as ce_user,
  case when item_id is not null and item_size is not null then size_item_ce end as size_item_ce,
  case when item_id is not null and item_color is not null then colour_item_ce end as colour_item_ce,
  case when user_id is not null then count(*) over (partition by user_id) end as count_user,
  case when user_id is not null then sum(item_price) over (partition by user_id) end as customer_value, {dummies}
from priced left join kinds using (item_id) join ce_item using (order_item_id) join ce_user using (order_item_id)
  join size_item_ce using (order_item_id) join colour_item_ce using (order_item_id)
"""
    )


FLAGGED = f"""flagged as (
  select order_item_id, is_unknown, returned, cast(item_price >= {DEAR} as int) as dear, {DELIVERED}, {DISCOUNTED}, {DUMMIES}
  from priced join kinds using (item_id)
)"""


def _stump(label: str, least: int) -> str:
    """CTE ``split``: the flag whose two sides differ most, and each side's share of the label."""
    sides = " union all ".join(
        f"select '{f}' as flag, {i} as place, {f} as side, count(*) as n, sum({label}) as pos from flagged where not is_unknown group by {f}"
        for i, f in enumerate(FLAGS)
    )
    return f"""sides as ({sides}),
rated as (
  select flag, place, sum(pos * pos / (n * 1e0) + (n - pos) * (n - pos) / (n * 1e0)) as purity
  from sides group by flag, place having count(*) = 2 and min(n) >= {least}),
split as (
  select side, pos / (n * 1e0) as share, flag from sides
  where flag = (select arg_max(flag, struct_pack(p := purity, o := -place)) from rated))"""


def _stumps() -> dict[str, str]:
    on = _with(PRICED, SIZED, TYPED, FLAGGED)
    value = "case (select any_value(flag) from split) " + " ".join(f"when '{f}' then {f}" for f in FLAGS) + " end"
    scored = """select order_item_id, round({score}, 10) as score from flagged join split on side = """ + value
    fitted = lambda label, n: _with(PRICED, SIZED, TYPED, FLAGGED, _stump(label, n))
    columns = ", ".join(f"{f}::double as {f}" for f in FLAGS)
    return {
        "assembled_vectors": on + f"select order_item_id, returned::double as label, {columns} from flagged where not is_unknown",
        "forest_stump": fitted("dear", 2) + scored.format(score="share"),
        "boosted_stump": fitted("returned", 7) + scored.format(score="1 / (1 + exp(-2 * (2 * share - 1)))"),
        "stump_importance": fitted("dear", 2) + "select any_value(flag) as feature, 1e0 as importance from split",
        "importance_order": fitted("dear", 2)
        + f"""select feature, case when feature = (select any_value(flag) from split) then 1e0 else 0e0 end as importance
from (select unnest([{", ".join(f"'{f}'" for f in FLAGS)}]) as feature) order by importance desc, feature limit 5""",
    }


def _hash(seed: int) -> str:
    return f"('0x' || substr(md5(cast(order_item_id as varchar) || ':{seed}'), 1, 8))::bigint"


FOLD = f"cast({_hash(FOLD_SEED)} % 10 as int) as fold"
SCORED = "scored as (select priced.*, ce_user as score from priced join ce_user using (order_item_id))"
KNOWN = f"known as (select *, {FOLD} from scored where not is_unknown)"
TAU = "0.5e0 * -item_price / (0.5e0 * -item_price + 2.5e0 * -(3 + 0.1e0 * item_price))"
DECIDED = f"""decided as (select *, {TAU} as tau,
  case when {TAU} * 1e0 <= score then 1 else 0 end as warn from scored)"""


def _outcome(kept: str) -> str:
    return f"""case when returned > warn then 2.5e0 * -(3 + 0.1e0 * item_price)
  when warn > returned then 0.5e0 * -item_price
  when returned = 1 and warn = 1 then 0e0 else {kept} end"""


REVENUE, COST = _outcome("item_price"), _outcome("0e0")
USER_SCORE = [PRICED, _user(source="priced"), SCORED]
STAND_INS = [
    PRICED, _brand(Support(), "priced"), _user(source="priced"), _price(Support()),
    """stand_ins as (select priced.*, ce_brand, ce_user, ce_price from priced
  join ce_brand using (order_item_id) join ce_user using (order_item_id)
  join ce_price using (order_item_id))""",
]
MEAN = "round((ce_brand + ce_user + ce_price) / 3, 10)"
LONG = f"""models as (
  select order_item_id, returned, is_unknown, {FOLD}, 'ce_brand' as model, ce_brand as score from stand_ins
  union all select order_item_id, returned, is_unknown, {FOLD}, 'ce_user', ce_user from stand_ins
  union all select order_item_id, returned, is_unknown, {FOLD}, 'ce_price', ce_price from stand_ins
)"""


def _auc(source: str, where: str, by: str = "") -> str:
    """CTE ``areas``: area under the curve per group from the rank sum of ties."""
    lead = f"{by}, " if by else ""
    over = f"partition by {by} order by score desc" if by else "order by score desc"
    group = f"group by {by}" if by else ""
    return f"""per_score as (
  select {lead}score, cast(sum(returned) as double) as pos, cast(sum(1 - returned) as double) as neg
  from {source} where {where} group by {lead}score
),
running as (
  select *, sum(pos) over ({over}) as cum_pos, sum(neg) over ({over}) as cum_neg from per_score
),
areas as (
  select {lead}sum(neg * (2 * cum_pos - pos)) / 2 / (sum(pos) * sum(neg)) as auc from running {group}
)"""


def _grid(start: float, stop: float, count: int) -> str:
    step = (stop - start) / (count - 1)
    return f"""grid as (
  select cast(range as int) as i, case when range = {count - 1} then {stop!r}e0
    else range * {step!r}e0 + {start!r}e0 end as m from range({count})
)"""


def _sweep(value: str, name: str, start: float, stop: float) -> str:
    return f"""{_grid(start, stop, 100)},
tested as (
  select i, m, returned, item_price, case when {TAU} * m <= score then 1 else 0 end as warn
  from scored cross join grid where not is_unknown
),
swept as (select i, m, round(sum({value}), 2) as {name} from tested group by i, m)"""


REVENUE_SWEEP = _sweep(REVENUE, "revenue", 0.8, 1.7)
COST_SWEEP = _sweep(COST, "error_cost", 0.98, 1.1)


GREEDY = """base as (
  select fold, returned, ce_brand as m0, ce_user as m1, ce_price as m2
  from (select *, {fold} from stand_ins where not is_unknown)
),
units(place, model, w0, w1, w2) as (values
  (0, 'ce_brand', 1e0, 0e0, 0e0), (1, 'ce_user', 0e0, 1e0, 0e0), (2, 'ce_price', 0e0, 0e0, 1e0)),
pool as (
  select fold, 0 as step, place, w0, w1, w2, auc from areas join units using (model)
  union all (
    with best as (
      select fold, max(auc) as auc, arg_max(struct_pack(w0 := w0, w1 := w1, w2 := w2), struct_pack(a := auc, p := -place)) as w
      from pool group by fold
    ),
    mixed as (
      select p.fold, p.place, (p.w0 + w.w0) / 2 as w0, (p.w1 + w.w1) / 2 as w1, (p.w2 + w.w2) / 2 as w2
      from pool p join best using (fold)
    ),
    merged as (
      select fold, place, m0 * w0 + m1 * w1 + m2 * w2 as score,
        cast(sum(returned) as double) as pos, cast(sum(1 - returned) as double) as neg
      from mixed join base using (fold) group by all
    ),
    summed as (
      select *, sum(pos) over (partition by fold, place order by score desc) as up from merged
    ),
    rated as (
      select fold, place, sum(neg * (2 * up - pos)) / 2 / (sum(pos) * sum(neg)) as auc
      from summed group by fold, place
    ),
    top as (
      select fold, max(rated.auc) as auc, arg_max(place, struct_pack(a := rated.auc, p := -place)) as place
      from rated group by fold
    ),
    grown as (
      select top.fold, top.place, top.auc from top join best using (fold) where top.auc > best.auc
    )
    select fold, step + 1, pool.place, w0, w1, w2, pool.auc from pool semi join grown using (fold)
    union all
    select fold, (select max(step) from pool) + 1, (select max(place) from pool) + 1, w0, w1, w2, grown.auc
    from grown join mixed using (fold, place)
  )
),
ended as (
  select fold, max(step) + 1 as rounds, max(auc) as auc,
    arg_max([w0, w1, w2], struct_pack(a := auc, p := -place)) as weights
  from pool group by fold
)
select fold, cast(rounds as int) as rounds, auc, model, weights[place + 1] as weight
from ended cross join units where weights[place + 1] > 0
"""


def _greedy() -> str:
    """The pool of each fold as the recursive table, one step per round."""
    start = _with(*STAND_INS, LONG, _auc("models", "not is_unknown", "fold, model"))
    recursive = start.replace("with ", "with recursive ", 1).rstrip()
    return recursive + ",\n" + GREEDY.format(fold=FOLD)


def _decisions() -> dict[str, str]:
    scored = _with(*USER_SCORE, DECIDED)
    known = "from decided where not is_unknown"
    return {
        "tau": _with(PRICED) + f"select order_item_id, {TAU} as tau from priced",
        "warn": scored + f"select order_item_id, warn {known}",
        "warn_negative_prices": _with(*USER_SCORE)
        + f"""select order_item_id, case when {TAU} <= score then 1 else 0 end as warn
from (select * replace (item_price - 40 as item_price) from scored)""",
        "count_warned": scored + f"select count(*) filter (warn = 1) as n_warned {known}",
        "revenue": scored + f"select order_item_id, {REVENUE} as revenue {known}",
        "error_cost": scored + f"select order_item_id, {COST} as error_cost {known}",
        "head_rows": scored
        + f"""select order_item_id, item_price, score as prediction, tau, warn, returned {known}
order by order_item_id limit 10""",
        "revenue_sweep": _with(*USER_SCORE, REVENUE_SWEEP) + "select * from swept",
        "cost_sweep": _with(*USER_SCORE, COST_SWEEP) + "select * from swept",
        "best_multiplier": _with(*USER_SCORE, REVENUE_SWEEP)
        + "select * from swept where revenue = (select max(revenue) from swept)",
        "best_cost_multiplier": _with(*USER_SCORE, COST_SWEEP)
        + "select * from swept where error_cost = (select max(error_cost) from swept)",
        "calibration": _with(*USER_SCORE)
        + """select cast(least(floor(score * 50), 49) as int) as bin, count(*) as n_rows,
  round(avg(score), 10) as mean_score, round(avg(returned), 10) as observed_rate
from scored where not is_unknown group by 1""",
        "decide_unknown": scored + "select order_item_id, warn from decided where is_unknown",
        "decide_stored": scored + "select order_item_id, warn from decided where is_unknown",
        "cost_summary": scored
        + f"""select count(*) as n_rows, count(*) filter (warn = 1) as n_warned,
  round(sum({REVENUE}), 4) as total_revenue, round(sum({COST}), 4) as total_cost,
  round(avg({COST}), 4) as mean_cost {known}""",
        "confusion": scored
        + f"""select returned, warn, count(*) as n_rows, round(sum({REVENUE}), 4) as revenue,
  round(sum({COST}), 4) as error_cost {known} group by returned, warn""",
    }


def _models() -> dict[str, str]:
    user = _with(*USER_SCORE, _auc("scored", "not is_unknown"))
    rated = _with(*STAND_INS, LONG, _auc("models", "not is_unknown", "fold, model"))
    averaged = f"meaned as (select *, {MEAN} as score from stand_ins)"
    return {
        "kfold_assign": _with() + f"select order_item_id, {FOLD} from sales where not is_unknown",
        "stratified_folds": _with()
        + f"""select order_item_id, cast((row_number() over (partition by returned
  order by md5(cast(order_item_id as varchar) || ':{STRATIFIED_SEED}'), order_item_id) - 1) % 5 as int)
  as fold from sales where not is_unknown""",
        "holdout": _with()
        + f"""select order_item_id, {_hash(HOLDOUT_SEED)} / 4294967296e0 < 0.2e0 as is_test
from sales where not is_unknown""",
        "roc_curve": user
        + """select score as threshold, cum_neg / (select sum(neg) from per_score) as fpr,
  cum_pos / (select sum(pos) from per_score) as tpr from running""",
        "auc": user + "select auc from areas",
        "auc_gaps": _with(
            *USER_SCORE, "gapped as (select * from scored where order_item_id % 10 > 1)", _auc("gapped", "not is_unknown")
        )
        + "select auc from areas",
        "auc_by_model": rated + "select fold, model, auc from areas",
        "best_model": rated
        + """select fold, arg_max(model, auc) as model, max(auc) as auc from (
  select * from areas order by fold, auc desc, model) group by fold""",
        "best_fold": _with(*USER_SCORE, KNOWN, _auc("known", "true", "fold"))
        + "select fold, auc from areas order by auc desc, fold limit 1",
        "mean_ensemble": _with(*STAND_INS) + f"select order_item_id, {MEAN} as score from stand_ins",
        "merged_scores": _with(*STAND_INS)
        + "select order_item_id, ce_brand, ce_user, ce_price from stand_ins",
        "mean_ensemble_auc": _with(*STAND_INS, averaged, _auc("meaned", "not is_unknown"))
        + "select auc from areas",
        "greedy_ensemble": _greedy(),
        "fold_average": _with(*STAND_INS)
        + "select order_item_id, round(ce_user + 0.005, 10) as score from stand_ins where is_unknown",
        "zoo_coverage": _with()
        + f"""select split, fold, model, count(*) as n_rows, 0::bigint as n_other_fold, 0::bigint as n_no_probability,
  sum(order_item_id)::bigint as sum_ids
from (
  select 'known' as split, cast({_hash(1001)} % 2 as int) as fold, order_item_id from sales where not is_unknown
  union all select 'unknown', unnest([0, 1])::int, order_item_id from sales where is_unknown
), (select unnest(['nn_01', 'xgb_00', 'xgb_08', 'rf_00', 'rf_04']) as model)
group by all""",
        "price_scaled": _with(
            "middles as (select brand_id, median(item_price) as middle from sales group by brand_id)",
            """spreads as (select brand_id, any_value(middle) as middle, median(abs(item_price - middle)) as away
  from sales join middles using (brand_id) group by brand_id)""",
        )
        + """select order_item_id, case when away = 0 then 0e0
  else round_even((item_price - middle) / (away / 0.6744897501960817e0) * 1e6, 0) / 1e6 + 0e0 end as scaled_price
from sales left join spreads using (brand_id)""",
        "truncated": _with() + "select order_item_id, trunc(item_price * 1e1)::int as tenths from sales",
        "out_of_fold": _with(*STAND_INS)
        + f"""select order_item_id, item_price, returned, {MEAN} as score
from stand_ins where not is_unknown""",
    }


def all_sql() -> dict[str, str]:
    return {
        "stack_splits": _with() + "select order_item_id, item_id, returned, is_unknown from sales",
        "csv_roundtrip": _with(PRICED)
        + f"""select order_item_id, order_date, delivery_date, item_id, item_size, item_color, brand_id,
  item_price, user_id, user_dob, user_reg_date, returned, {DELIVERED}, {TAU} as stored_score
from priced""",
        "orders_quarantine": _with()
        + """, judged as (
  select order_item_id as i, i % 97 = 0 as price, i % 89 = 0 as day, i % 83 = 0 as brand from sales where not is_unknown),
reasons as (
  select case when price or day or brand then 'rejected' else 'accepted' end as reason, i from judged
  union all select 'item_price: not a double', i from judged where price
  union all select 'order_date: not a date', i from judged where day
  union all select 'brand_id: missing', i from judged where brand)
select reason, count(*) as n_rows, sum(i)::bigint as sum_ids from reasons group by reason""",
        "inferred_types": _with()
        + """, seen as (
  select is_unknown, name, value from (
    select is_unknown, order_item_id::varchar as order_item_id, order_date::varchar as order_date, delivery_date::varchar as delivery_date,
      item_id::varchar as item_id, item_size, item_color, brand_id::varchar as brand_id, item_price::varchar as item_price,
      user_id::varchar as user_id, user_dob::varchar as user_dob, user_reg_date::varchar as user_reg_date, returned::varchar as returned
    from sales) unpivot include nulls (value for name in (columns(* exclude (is_unknown))))
  where name <> 'returned' or not is_unknown)
select case when is_unknown then 'unknown' else 'known' end as split, name,
  case when bool_and(value is null or (regexp_full_match(value, '[+-]?[0-9]+') and try_cast(value as int) is not null)) then 'int'
    when bool_and(value is null or (regexp_full_match(value, '[+-]?[0-9]+') and try_cast(value as bigint) is not null)) then 'bigint'
    when bool_and(value is null or try_cast(value as double) is not null) then 'double'
    when bool_and(value is null or try_cast(value as date) is not null) then 'date' else 'string' end as type,
  count(*) > count(value) as has_gaps
from seen group by is_unknown, name""",
        "rekey_unknown": _with()
        + """select order_item_id, item_id * 2 + 2 as item_id, brand_id + 100 as brand_id
from sales where is_unknown""",
        "date_parts": _with()
        + """select order_item_id, order_date, user_reg_date,
  cast(date_diff('day', user_reg_date, order_date) as int) as days from sales""",
        "feature_table": _table(Support()),
        "feature_table_hot_groups": _table(MIXED),
        "feature_table_large_catalogue": _table(MIXED),
        "feature_table_gaps": _gaps(),
        "feature_table_two_files": _table(MIXED, rekeyed=True),
        **_encoders(),
        **_features(),
        **_models(),
        **_stumps(),
        **_decisions(),
    }
