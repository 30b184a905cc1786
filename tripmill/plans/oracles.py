"""The same results in plain SQL over the raw tables, written independently of the operators.

Each text starts from a trips view inlined as a common table expression.
"""

from __future__ import annotations

from tripmill.operators.bayes import setting_names
from tripmill.operators.models import BAYES_GRID, TREE_CHOICE, TREE_SETTINGS
from tripmill.plans.queries import CLIP, LOW_VOLUME_FRACTION, RULES, TOP_CELLS
from tripmill.plans.tree_sql import grown_tree, predictions, pruned_nodes

_TRIPS = """
base as (
  select *,
    date_trunc('second', ts) as pickup,
    cast(floor(value * 15) as int) as seconds,
    ((event_id % 250000) * 7919) % 250000 as px,
    ((user_id % 220000) * 104729 + (event_id % 220000) * 31) % 220000 as py,
    ((event_id % 40000) * 1299709) % 40000 - 20000 as dx,
    ((event_id % 60000) * 15485863) % 60000 - 30000 as dy
  from events
), trips as (
  select
    'id' || cast(event_id as varchar) as id,
    cast(user_id % 2 + 1 as int) as vendor_id,
    pickup as pickup_datetime,
    pickup + to_seconds(seconds) as dropoff_datetime,
    cast(user_id % 7 as int) as passenger_count,
    cast(px - 74030000 as double) / 1000000 as pickup_longitude,
    cast(py + 40630000 as double) / 1000000 as pickup_latitude,
    cast(px + dx - 74030000 as double) / 1000000 as dropoff_longitude,
    cast(py + dy + 40630000 as double) / 1000000 as dropoff_latitude,
    case when event_type = 'error' then 'Y' else 'N' end as store_and_fwd_flag,
    seconds as trip_duration,
    event_id
  from base
), trips_raw as (
  select * replace (
    case when event_id % 101 <> 0 then passenger_count end as passenger_count
  )
  from trips
)"""

_KEEP = f"""(pickup_datetime < timestamp '{RULES.exclude_from}'
      or pickup_datetime > timestamp '{RULES.exclude_to}')
    and (dropoff_datetime < timestamp '{RULES.exclude_from}'
      or dropoff_datetime > timestamp '{RULES.exclude_to}')
    and dropoff_datetime < timestamp '{RULES.cutoff}'"""

_CLEAN = f""", cleaned as (
  select * from trips_raw where passenger_count is not null and {_KEEP}
)"""

_COORDINATES = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
_PRINTED = """id, vendor_id,
    strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') as pickup_datetime,
    strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') as dropoff_datetime,
    passenger_count, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
    store_and_fwd_flag, trip_duration"""


def _sql(body: str, views: str = "") -> str:
    return f"with {_TRIPS}{views}\n{body}"


def _frequency(column: str, table: str = "trips") -> str:
    return _sql(f"select {column} as tag, count(*) as n from {table} group by 1 order by 1")


def _share(column: str) -> str:
    return _sql(
        f"select {column} as tag, count(*) as n, "
        "round(count(*) * cast(100 as double) / sum(count(*)) over (), 6) as pct "
        "from trips group by 1"
    )


def _days(column: str, table: str = "trips", views: str = "") -> str:
    return _sql(
        f"select strftime({column}, '%Y-%m-%d') as day, count(*) as n from {table} group by 1", views
    )


def _cell(column: str) -> str:
    return f"floor({column} * 100 + 0.5) / cast(100 as double)"


def _grid(end: str, tail: str = "") -> str:
    return _sql(
        f"select {_cell(end + '_latitude')} as lat, {_cell(end + '_longitude')} as lon, "
        f"count(*) as n from trips group by 1, 2 {tail}"
    )


def _histogram_parts(column: str, where: str, name: str) -> str:
    return f"""
{name}_v as (select {column} as x from trips where {where}),
{name}_b as (select min(x) as mn, max(x) as mx from {name}_v),
{name}_c as (
  select cast(least(floor((x - mn) / (mx - mn) * 40), 39) as int) as bucket, count(*) as n
  from {name}_v, {name}_b group by 1
),
{name}_h as (
  select cast(s.bucket as int) as bucket,
    round(mn + s.bucket * (mx - mn) / cast(40 as double), 6) as lo,
    round(case when s.bucket = 39 then mx
      else mn + (s.bucket + 1) * (mx - mn) / cast(40 as double) end, 6) as hi,
    coalesce(n, 0) as n
  from range(0, 40) as s(bucket) cross join {name}_b left join {name}_c using (bucket)
)"""


def _histogram(column: str, where: str = "true", fields: str | None = None) -> str:
    fields = fields or (
        "bucket, lo, hi, '[' || cast(lo as varchar) || ', ' || cast(hi as varchar) || ']' as label, n"
    )
    return _sql(f"select {fields} from h_h", "," + _histogram_parts(column, where, "h"))


def _all_histograms() -> str:
    views = "".join("," + _histogram_parts(c, "true", c) for c in _COORDINATES)
    label = "'[' || cast(lo as varchar) || ', ' || cast(hi as varchar) || ']' as label"
    return _sql(
        " union all ".join(
            f"select '{c}' as \"column\", bucket, lo, hi, {label}, n from {c}_h"
            for c in _COORDINATES
        ),
        views,
    )


_VARIABLES = ["vendor_id", "passenger_count", *_COORDINATES, "store_and_fwd_flag_int"]
_FLAGGED = """, flagged as (
  select *, case when store_and_fwd_flag = 'Y' then 1 else 0 end as store_and_fwd_flag_int
  from trips
)"""
_FLAGGED_RAW = _FLAGGED.replace("from trips", "from trips_raw")


def _corr(a: str, b: str) -> str:
    return "max(cast(1 as double))" if a == b else f"round(corr({a}, {b}), 6)"


def _corr_rows() -> str:
    rows = [
        f"select '{a}' as \"row\", '{b}' as \"col\", {_corr(a, b)} as corr from flagged"
        for a in _VARIABLES
        for b in _VARIABLES
    ]
    return _sql(" union all ".join(rows), _FLAGGED_RAW)


def _corr_lines(with_names: bool) -> str:
    lines = []
    for i, a in enumerate(_VARIABLES):
        head = f"{i + 1} as position, '{a}' as \"row\", " if with_names else ""
        cells = ", ".join(
            f"{_corr(a, b)} as {b}" for b in _VARIABLES
        )
        lines.append(f"select {head}{cells} from flagged")
    return _sql(" union all ".join(lines), _FLAGGED)


def _summary() -> str:
    columns = ["vendor_id", "passenger_count", "trip_duration", *_COORDINATES]
    return _sql(
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), 6) as mean, "
            f"round(stddev_pop({c}), 6) as stdev_pop, round(cast(max({c}) as double), 6) as max, "
            f"round(cast(min({c}) as double), 6) as min from trips_raw"
            for c in columns
        )
    )


def _profile_rows() -> str:
    """Every figure of the profile job, as (report, item, measure, value)."""

    def counts(report: str, item: str) -> str:
        return (
            f"select '{report}' as report, {item} as item, 'n' as measure, count(*)::double as value "
            "from trips_raw group by 2"
        )

    parts = [counts(c, f"cast({c} as varchar)") for c in ("vendor_id", "passenger_count", "trip_duration")]
    parts += [counts(f"{end}_datetime", f"strftime({end}_datetime, '%Y-%m-%d')") for end in ("pickup", "dropoff")]
    parts += [
        counts(f"{end}_grid", f"cast({_cell(end + '_latitude')} as varchar) || ',' || cast({_cell(end + '_longitude')} as varchar)")
        for end in ("pickup", "dropoff")
    ]
    parts += [counts("store_and_fwd_flag", "store_and_fwd_flag"), f"({counts('id', 'id')} order by 2 limit 20)"]
    parts.append(
        "select 'store_and_fwd_flag', store_and_fwd_flag, 'pct', "
        "round(count(*) * 100.0::double / sum(count(*)) over (), 6) from trips_raw group by 2"
    )
    parts += [
        f"select '{c}', cast(bucket as varchar), '{m}', {m}::double from {c}_h"
        for c in _COORDINATES
        for m in ("lo", "hi", "n")
    ]
    for c in ["vendor_id", "passenger_count", "trip_duration", *_COORDINATES]:
        for measure, value in (("count", f"count({c})"), ("mean", f"avg({c})"), ("max", f"max({c})"),
                               ("stdev_pop", f"stddev_pop({c})"), ("min", f"min({c})")):
            digits = 5 if measure == "mean" else 6
            parts.append(f"select 'summary', '{c}', '{measure}', round({value}::double, {digits}) from trips_raw")
    parts += [
        f"select 'correlation', '{a},{b}', 'corr', {_corr(a, b)} from flagged"
        for a in _VARIABLES
        for b in _VARIABLES
    ]
    views = "".join("," + _histogram_parts(c, "true", c) for c in _COORDINATES)
    return _sql(" union all ".join(parts), _FLAGGED_RAW + views)


def _seconds(c: str) -> str:
    return f"cast(hour({c}) * 3600 + minute({c}) * 60 + second({c}) as double)"


def _weekday(c: str) -> str:
    return f"cast(dayofweek({c}) + 1 as varchar)"


def _bucket(salt: str = "", buckets: int = 100) -> str:
    return f"(('0x' || substring(md5('{salt}' || id), 1, 8))::bigint % {buckets})"


_LOSS = f"""select count(*) as n_total,
    count(*) filter (passenger_count is null) as n_null,
    count(*) filter (passenger_count is not null and not ({_KEEP})) as n_outlier,
    round(count(*) filter (passenger_count is null or not ({_KEEP}))
      / cast(count(*) as double), 6) as loss_rate
  from trips_raw"""

_CATEGORIES = f""", categories as (
  select id, store_and_fwd_flag,
    {_weekday('pickup_datetime')} as pickup_datetime_weekday,
    {_weekday('dropoff_datetime')} as dropoff_datetime_weekday
  from trips
)"""


def _index(column: str) -> str:
    """Position among the values in falling order, over the whole table."""
    return f"cast(dense_rank() over (order by {column} desc) - 1 as double)"


def _hot(column: str, values: list[str]) -> list[str]:
    return [f"case when {column} = '{v}' then 1.0::double else 0.0::double end" for v in values]


_WEEKDAYS = ["7", "6", "5", "4", "3", "2"]  # '1' comes last and has no slot


def _slots(table: str, shift: bool) -> str:
    """f0..f20 and the label, as a view named encoded."""
    lon, lat = ("+ 180.0::double", "+ 90.0::double") if shift else ("", "")
    values = [
        "cast(vendor_id as double)",
        "cast(passenger_count as double)",
        f"pickup_longitude {lon}",
        f"pickup_latitude {lat}",
        f"dropoff_longitude {lon}",
        f"dropoff_latitude {lat}",
        _seconds("pickup_datetime"),
        _seconds("dropoff_datetime"),
        *_hot("store_and_fwd_flag", ["Y"]),
        *_hot(_weekday("pickup_datetime"), _WEEKDAYS),
        *_hot(_weekday("dropoff_datetime"), _WEEKDAYS),
    ]
    columns = ", ".join(f"{v} as f{i}" for i, v in enumerate(values))
    return f""", encoded as (
  select id, case when trip_duration < 1200 then 0.0::double else 1.0::double end as label,
    {columns}
  from {table}
)"""


def _vector(shift: bool) -> str:
    slots = ", ".join(f"round(f{i}, 6) as f{i}" for i in range(21))
    return _sql(f"select id, label, {slots} from encoded", _CLEAN + _slots("cleaned", shift))


def _bayes(source: str) -> str:
    """Log-probabilities of multinomial Naive Bayes with smoothing 100, one row per class."""
    sums = ", ".join(f"sum(f{i}) as s{i}" for i in range(21))
    total = " + ".join(f"s{i}" for i in range(21))
    theta = ", ".join(f"ln(s{i} + 100) - ln({total} + 21 * 100) as t{i}" for i in range(21))
    return f""", sums as (
  select label, count(*) as n_class, {sums} from {source} group by label
), fitted as (
  select label, ln(n_class + 100) - ln(sum(n_class) over () + 2 * 100) as pi, {theta} from sums
)"""


def _bayes_rows() -> str:
    rows = [
        f"select label, {i} as feature, round(t{i}, 6) as theta, round(pi, 6) as pi from fitted"
        for i in range(21)
    ]
    return _sql(
        " union all ".join(rows), _CLEAN + _slots("cleaned", True) + _bayes("encoded")
    )


def _bayes_confusion(where: str = f"{_bucket()} >= 66") -> str:
    dot = " + ".join(f"f{i} * t{i}" for i in range(21))
    return _sql(
        f"""select label, prediction, count(*) as n from (
  select e.id, e.label, max_by(m.label, m.pi + {dot}) as prediction
  from encoded e cross join fitted m where {where} group by e.id, e.label
) group by 1, 2""",
        _CLEAN
        + _slots("cleaned", True)
        + f", learned as (select * from encoded where {_bucket()} < 66)"
        + _bayes("learned"),
    )


def _bayes_folds() -> str:
    """Areas under the ROC curve per fold and setting, as a view named areas."""
    learned = f", learned as (select *, cast({_bucket('fold', 3)} as int) as fold from encoded where {_bucket()} < 66)"
    sums = ", ".join(f"sum(f{i}) as s{i}" for i in range(21))
    rest = ", ".join(f"w.s{i} - o.s{i} as s{i}" for i in range(21))
    logs = ", ".join(f"ln(s{i} + smoothing) - ln({' + '.join(f's{k}' for k in range(21))} + 21 * smoothing) as t{i}"
                     for i in range(21))
    # of two classes the complement of one is the other, so both types weigh slots alike
    margin = " + ".join(f"f{i} * (b.t{i} - a.t{i})" for i in range(21))
    settings = ", ".join(
        f"('modelType={kind}, smoothing={s}', '{kind}', {s}::double)"
        for kind in BAYES_GRID["modelType"]
        for s in BAYES_GRID["smoothing"]
    )
    return f"""{learned}, own as (select fold, label, count(*) as n, {sums} from learned group by 1, 2
), outside as (
  select o.fold, o.label, w.n - o.n as n, {rest}
  from own o join (select label, count(*) as n, {sums} from learned group by 1) w using (label)
), settings as (select * from (values {settings}) as s(params, kind, smoothing)
), logs as materialized (
  select params, kind, fold, label, case when kind = 'multinomial' then ln(n + smoothing) else 0 end as pi, {logs}
  from outside, settings
), margins as (
  select a.params, x.fold, x.label, round({margin} + b.pi - a.pi, 9) as score
  from learned x join logs a on a.fold = x.fold and a.label = 0
    join logs b on b.fold = x.fold and b.label = 1 and b.params = a.params
), ranked as (
  select params, fold, pos, neg, sum(neg) over (partition by params, fold order by score) - neg as below
  from (select params, fold, score, sum(label) as pos, sum(1 - label) as neg from margins group by 1, 2, 3)
), areas as materialized (
  select params, fold, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) as auc from ranked group by 1, 2
)"""


def _bayes_areas() -> str:
    return _sql(
        "select params, fold, round(auc, 6) as auc from areas",
        _CLEAN + _slots("cleaned", True) + _bayes_folds(),
    )


def _bayes_tuning() -> str:
    order = ", ".join(f"'{n}'" for n in setting_names(BAYES_GRID))
    return _sql(
        "select params, round(mean, 6) as avg_auc, round(spread, 6) as std_auc, "
        f"row_number() over (order by round(mean, 12) desc, list_position([{order}], params)) = 1 as chosen "
        "from (select params, avg(auc) as mean, stddev_pop(auc) as spread from areas group by 1)",
        _CLEAN + _slots("cleaned", True) + _bayes_folds(),
    )


def _grown(fit: str, with_dropoff_time: bool = True) -> tuple[str, str, list[str], int]:
    """(views, name of the source, slots, numeric slots) for trees fitted where `fit` holds."""
    kept = [i for i in range(21) if with_dropoff_time or i not in (7, *range(15, 21))]
    view = f", sides as (select *, {fit} as fit from encoded)"
    slots = [f"f{i}" for i in kept]
    return _CLEAN + _slots("cleaned", False) + view, "sides", slots, sum(i < 8 for i in kept)


def _tree_confusion(with_dropoff_time: bool = True, where: str = "not fit") -> str:
    views, source, slots, numeric = _grown(f"{_bucket()} < 66", with_dropoff_time)
    _, depth, bins = TREE_CHOICE
    return _sql(
        f"select label, prediction, count(*) as n from predicted where {where} group by 1, 2",
        views + grown_tree(source, slots, numeric, depth, bins) + predictions(source, depth),
    )


def _tree_rows() -> str:
    views, source, slots, numeric = _grown(f"{_bucket()} < 66")
    _, depth, bins = TREE_CHOICE
    return _sql(
        "select 0 as tree, cast(node as int) as node, cast(floor(log2(node)) as int) as depth, "
        "cast(feature as int) as feature, round(threshold, 6) as threshold, category, "
        "cast(case when feature is not null then 2 * node end as int) as \"left\", "
        "cast(case when feature is not null then 2 * node + 1 end as int) as \"right\", "
        "n0 as n_short, n1 as n_long, case when n1 > n0 then 1.0::double else 0.0::double end "
        "as prediction, round(gain, 9) as gain from t_pruned",
        views + grown_tree(source, slots, numeric, depth, bins) + pruned_nodes(),
    )


def _tree_settings() -> str:
    """Error rates of all settings; those that differ in depth alone share a tree."""
    views, source, slots, numeric = _grown(f"{_bucket('inner')} < 66")
    rows = []
    for bins in dict.fromkeys(b for _, _, b in TREE_SETTINGS):
        depths = [d for _, d, b in TREE_SETTINGS if b == bins]
        views += grown_tree(source, slots, numeric, max(depths), bins, f"t{bins}")
        for depth in depths:
            name = f"p{bins}_{depth}"
            views += predictions(source, depth, f"t{bins}", name)
            rows.append(
                f"select 'gini' as impurity, {depth} as max_depth, {bins} as max_bins, count(*) as n_valid, "
                "round(avg(case when prediction <> label then 1.0::double else 0.0::double end), 6) "
                f"as error_rate from {name} where not fit"
            )
    return _sql(" union all ".join(rows), views)


_RULE = """, clock as (
  select case when trip_duration < 1200 then 0.0::double else 1.0::double end as label,
    (hour(dropoff_datetime) - hour(pickup_datetime)) * 3600
      + (minute(dropoff_datetime) - minute(pickup_datetime)) * 60 as s,
    s + second(dropoff_datetime) - second(pickup_datetime) + passenger_count * 100 as fine
  from trips
), ruled as (
  select label, case when s >= 1080 then 1.0::double else 0.0::double end as prediction,
    fine / cast(7200 as double) as score
  from clock
)"""


def _metrics(label: str, prediction: str) -> str:
    return _sql(
        """select unnest(['error_rate', 'weighted_precision', 'weighted_fpr', 'auc_roc', 'auc_pr',
      'tpr', 'fpr']) as metric,
    unnest([round((fp + fn) / n, 6),
      round(((tp / (tp + fp)) * (tp + fn) + (tn / (tn + fn)) * (tn + fp)) / n, 6),
      round((fp / (fp + tn) * (tp + fn) + fn / (tp + fn) * (fp + tn)) / n, 6),
      round((tp / (tp + fn) - fp / (fp + tn) + 1) / 2, 6),
      round(tp / (tp + fn) * (tp / (tp + fp))
        + fn / (tp + fn) * (tp / (tp + fp) + (tp + fn) / n) / 2, 6),
      round(tp / (tp + fn), 6), round(fp / (fp + tn), 6)]) as value
  from cells""",
        _RULE
        + f""", cells as (
  select count(*)::double as n,
    count(*) filter ({label} = 1 and {prediction} = 1)::double as tp,
    count(*) filter ({label} = 0 and {prediction} = 1)::double as fp,
    count(*) filter ({label} = 1 and {prediction} = 0)::double as fn,
    count(*) filter ({label} = 0 and {prediction} = 0)::double as tn
  from ruled
)""",
    )


def _curve(score: str) -> str:
    return (
        _RULE
        + f""", groups as (
  select {score} as s, sum(label) as pos, sum(1 - label) as neg from ruled group by 1
), run as (
  select row_number() over (order by s desc) as point,
    sum(pos) over (order by s desc) as tp, sum(neg) over (order by s desc) as fp,
    sum(pos) over () as p, sum(neg) over () as n, count(*) over () as k
  from groups
), roc as (
  select 0::bigint as point, 0.0::double as fpr, 0.0::double as tpr
  union all select point, fp / n, tp / p from run
  union all select max(k) + 1, 1.0::double, 1.0::double from run
), pr as (
  select 0::bigint as point, 0.0::double as recall, tp / (tp + fp) as precision from run where point = 1
  union all select point, tp / p, tp / (tp + fp) from run
), roc_area as (
  select sum((fpr - x0) * (tpr + y0) / 2) as area from (
    select *, lag(fpr) over (order by point) as x0, lag(tpr) over (order by point) as y0 from roc)
), pr_area as (
  select sum((recall - x0) * (precision + y0) / 2) as area from (
    select *, lag(recall) over (order by point) as x0,
      lag(precision) over (order by point) as y0 from pr)
)"""
    )


_HARD = _curve("prediction")
_SCORED = _curve("score")
_ROC = "select point, round(fpr, 6) as fpr, round(tpr, 6) as tpr from roc"


def oracle_sql() -> dict[str, str]:
    sql = {
        "csv_scan_roundtrip": _sql(f"select {_PRINTED} from trips"),
        "series_sink": _frequency("passenger_count"),
        "series_sink_lines": (
            "select row_number() over (order by tag nulls first) as line, cast(n as varchar) as value,"
            r" coalesce(cast(tag as varchar), '\N') as tag"
            f" from ({_frequency('trip_duration')})"
        ),
        "histogram_sink": _histogram("pickup_longitude", fields="bucket, lo, hi, n"),
        "grid_sink": _grid("pickup"),
        "matrix_sink": _corr_lines(with_names=False),
        "preview": _sql(f"select {_PRINTED} from trips order by id limit 20"),
        "freq_vendor": _frequency("vendor_id"),
        "freq_passengers": _frequency("passenger_count", "trips_raw"),
        "freq_duration": _frequency("trip_duration"),
        "freq_flag_share": _share("store_and_fwd_flag"),
        "freq_vendor_share": _share("vendor_id"),
        "freq_id_preview": _frequency("id") + " limit 20",
        "trips_per_pickup_day": _days("pickup_datetime"),
        "trips_per_dropoff_day": _days("dropoff_datetime"),
        "clean_trips_per_day": _days(
            "pickup_datetime", "kept", f", kept as (select * from trips where {_KEEP})"
        ),
        "low_volume_days": _sql(
            "select day, n, median_n from daily, middle "
            f"where n < median_n * cast({LOW_VOLUME_FRACTION} as double)",
            ", daily as (select strftime(dropoff_datetime, '%Y-%m-%d') as day, count(*) as n "
            "from trips group by 1), "
            "middle as (select cast(quantile_disc(n, 0.5) as double) as median_n from daily)",
        ),
        "grid_density_pickup": _grid("pickup"),
        "grid_density_dropoff": _grid("dropoff"),
        "grid_topk": _grid("pickup", f"order by n desc, lat, lon limit {TOP_CELLS}"),
        "numeric_summary": _summary(),
        "profile_report": _profile_rows(),
        "histogram_clipped": _histogram(
            CLIP["column"],
            f"{CLIP['column']} between cast({CLIP['lo']} as double) and cast({CLIP['hi']} as double)",
        ),
        "histogram_all_coordinates": _all_histograms(),
        "flag_self_join": _sql(
            "select a.id, b.id2, a.store_and_fwd_flag, b.store_and_fwd_flag_int from trips a "
            "join (select distinct id as id2, store_and_fwd_flag_int from flagged) b on a.id = b.id2",
            _FLAGGED,
        ),
        "flag_column": _sql(
            "select a.id, a.store_and_fwd_flag, b.store_and_fwd_flag_int "
            "from trips a join flagged b on a.id = b.id",
            _FLAGGED,
        ),
        "corr_pair": _sql(
            "select round(corr(passenger_count, pickup_latitude), 6) as corr from trips_raw"
        ),
        "corr_matrix": _corr_rows(),
        "corr_heatmap": _corr_lines(with_names=True),
        "clean_rows": _sql(f"select {_PRINTED} from cleaned", _CLEAN),
        "clean_loss_rate": _sql(_LOSS),
        "clean_test_loss_rate": _sql(f"{_LOSS} where {_bucket()} >= 66"),
        "duration_class": _sql(
            "select id, case when trip_duration < 1200 then 'short' else 'long' end "
            "as trip_duration from trips"
        ),
        "duration_median_exact": _sql(
            "select quantile_disc(trip_duration, 0.5) as median from trips"
        ),
        "split_datetimes": _sql(
            "select id, "
            + ", ".join(
                f"{_seconds(c)} as {c}_time, {_weekday(c)} as {c}_weekday"
                for c in ("pickup_datetime", "dropoff_datetime")
            )
            + " from trips"
        ),
        "shifted_coordinates": _sql(
            "select id, "
            + ", ".join(
                f"round({c} + {180 if 'longitude' in c else 90}, 6) as {c}" for c in _COORDINATES
            )
            + " from trips"
        ),
        "hash_split_counts": _sql(
            f"select case when {_bucket()} < 66 then 'train' else 'test' end as side, "
            "count(*) as n from trips group by 1"
        ),
        "inner_split_counts": _sql(
            f"select case when {_bucket('inner')} < 66 then 'fit' else 'valid' end as side, "
            f"count(*) as n from trips where {_bucket()} < 66 group by 1"
        ),
        "fold_counts": _sql(
            f"select cast({_bucket('fold', 3)} as int) as fold, count(*) as n from trips group by 1"
        ),
        "hash_split_rows": _sql(
            f"select id, case when {_bucket()} < 66 then 'train' else 'test' end as side from trips"
        ),
        "random_split_cover": _sql(
            "select count(*) as n_rows, count(*) as n_split, true as same_rows from trips"
        ),
        "string_index": _sql(
            "select id, "
            + ", ".join(
                f"{_index(c)} as {c}_num"
                for c in (
                    "store_and_fwd_flag",
                    "pickup_datetime_weekday",
                    "dropoff_datetime_weekday",
                )
            )
            + " from categories",
            _CATEGORIES,
        ),
        "label_index": _sql(
            f"select id, {_index('cls')} as fitted, "
            "case when cls = 'long' then 1.0::double else 0.0::double end as fixed from classed",
            ", classed as (select id, case when trip_duration < 1200 then 'short' else 'long' end "
            "as cls from trips)",
        ),
        "one_hot_vectors": _sql(
            "select id, "
            + ", ".join(
                f"{slot} as {c}_{i}"
                for c, values in (
                    ("store_and_fwd_flag", ["Y"]),
                    ("pickup_datetime_weekday", _WEEKDAYS),
                    ("dropoff_datetime_weekday", _WEEKDAYS),
                )
                for i, slot in enumerate(_hot(c, values))
            )
            + " from categories",
            _CATEGORIES,
        ),
        "feature_vector": _vector(shift=False),
        "feature_vector_shifted": _vector(shift=True),
        "error_rate": _sql(
            "select count(*) as n_total, count(*) filter (prediction <> label) as n_wrong, "
            "round(avg(case when prediction <> label then 1.0::double else 0.0::double end), 6) "
            "as error_rate from ruled",
            _RULE,
        ),
        "confusion_matrix": _sql(
            "select label, prediction, count(*) as n from ruled group by 1, 2", _RULE
        ),
        "weighted_metrics": _metrics("label", "prediction"),
        "swapped_metrics": _metrics("prediction", "label"),
        "roc_curve": _sql(_ROC, _HARD),
        "pr_curve": _sql(
            "select point, round(recall, 6) as recall, round(precision, 6) as precision from pr",
            _HARD,
        ),
        "auc_roc": _sql("select round(area, 6) as auc_roc from roc_area", _HARD),
        "auc_pr": _sql("select round(area, 6) as auc_pr from pr_area", _HARD),
        "score_roc_curve": _sql(_ROC, _SCORED),
        "score_auc": _sql(
            "select 'auc_roc' as metric, round(area, 6) as value from roc_area "
            "union all select 'auc_pr', round(area, 6) from pr_area",
            _SCORED,
        ),
        "nb_cv": _bayes_tuning(),
        "nb_cv_folds": _bayes_areas(),
        "nb_model": _bayes_rows(),
        "nb_score": _bayes_confusion(),
        "duration_median_approx": _sql(
            "select count(trip_duration) as n, true as within from trips"
        ),
        "dt_grid": _tree_settings(),
        "dt_score": _tree_confusion(),
        "dt_score_without_dropoff_time": _tree_confusion(with_dropoff_time=False),
        "model_rules": _tree_rows(),
        "save_load_score": _tree_confusion(where="true"),
        "save_load_score_nb": _bayes_confusion("true"),
    }
    for c in _COORDINATES:
        sql[f"histogram_{c}"] = _histogram(c)
    return sql
