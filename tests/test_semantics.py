"""Small frames for the meanings that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonetide.functions import columns as C
from zonetide.operators import changes as X
from zonetide.operators import curate as U
from zonetide.operators import filters as P
from zonetide.operators import ordering as T
from zonetide.operators import quality as D
from zonetide.operators import rollups as A
from zonetide.plans import features as M
from zonetide.plans import serving as S
from zonetide.sources import roles
from zonetide.streaming import windows as W

AS_OF = "2024-01-31 00:00:00"


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


# --- curation -------------------------------------------------------------------------------------------------------

def test_clean_trips_edges(spark):
    ts = dt.datetime(2024, 1, 1)
    good = dict(p=ts, d=ts, trip_distance=1.0, fare_amount=1.0, total_amount=1.0, passenger_count=1)
    edges = [
        (good, True), ({**good, "passenger_count": 6}, True), ({**good, "passenger_count": 7}, False),
        ({**good, "passenger_count": 0}, False), ({**good, "passenger_count": None}, False),
        ({**good, "p": None}, False), ({**good, "d": None}, False), ({**good, "trip_distance": 0.0}, False),
        ({**good, "fare_amount": -1.0}, False), ({**good, "total_amount": 0.0}, False),
    ]
    schema = ("p timestamp, d timestamp, trip_distance double, fare_amount double, total_amount double, "
              "passenger_count int, row int")  # fmt: skip
    df = spark.createDataFrame([tuple(r.values()) + (i,) for i, (r, _) in enumerate(edges)], schema)
    kept = {r.row for r in U.clean_trips(df, "p", "d").collect()}
    assert kept == {i for i, (_, keep) in enumerate(edges) if keep}


def test_curated_columns(spark, sf_dir):
    got = U.curate_trips(roles.raw_o(spark, sf_dir), AS_OF)
    assert got.columns == list(U.CURATED_ORDER) and len(got.columns) == 23


# --- scalars --------------------------------------------------------------------------------------------------------

def test_weekday_numbers(spark):
    days = [dt.datetime(2024, 1, 6) + dt.timedelta(days=i) for i in range(3)]  # Saturday, Sunday, Monday
    df = spark.createDataFrame([(d,) for d in days], "t timestamp")
    got = [(r.n, r.w) for r in df.select(F.dayofweek("t").alias("n"), C.is_weekend("t").alias("w")).collect()]
    assert got == [(7, True), (1, True), (2, False)]


def test_condition_code_defaults_differ(spark):
    r = one(spark, a=C.condition_code(F.lit("haze"), 0), b=C.condition_code(F.lit("haze"), 1),
            c=C.condition_code(F.lit("fog"), 0), d=C.condition_code(F.lit(None).cast("string"), 1))
    assert (r.a, r.b, r.c, r.d) == (0.0, 1.0, 5.0, 1.0)


def test_rounding_ignores_float_noise(spark):
    r = one(spark, a=C.rnd(C.num(1.005), 2), b=C.rnd(C.num(10.014999999999999), 2), c=C.rnd(C.num(-2.5), 0))
    assert (r.a, r.b, r.c) == (1.01, 10.02, -3.0)


def test_null_safe_scalars(spark):
    none = F.lit(None)
    r = one(
        spark, cross=C.is_cross(F.lit("Queens"), none.cast("string")), airport=C.is_airport(none.cast("string")),
        flag=C.flag(none.cast("boolean")), bad=C.bad_weather(none.cast("string")),
        tip=C.tip_pct(F.lit(1.0), F.lit(0.0)), share=C.share_pct(F.lit(1), F.lit(0)),
        speed=C.distance_per_hour(F.lit(2.0), F.lit(-3.0)), total=C.total(F.lit(1.5), none.cast("double")),
        ts=C.parse_ts(F.lit("soon")), peak=C.peak_factor(F.lit(3), F.lit(0.0)),
    )
    assert (r.cross, r.airport, r.flag, r.bad, r.tip, r.share) == (False, False, 0, False, 0.0, None)
    assert (r.speed, r.total, r.ts, r.peak) == (0.0, 1.5, None, 1.0)


def test_weather_factor_order(spark):
    r = one(spark, wet_cold=C.demand_weather_factor(F.lit("rain"), F.lit(-5.0)),
            cold=C.demand_weather_factor(F.lit("clear"), F.lit(-5.0)),
            hot=C.demand_weather_factor(F.lit("haze"), F.lit(31.0)),
            none=C.demand_weather_factor(F.lit(None).cast("string"), F.lit(None).cast("double")))
    assert (r.wet_cold, r.cold, r.hot, r.none) == (1.3, 1.2, 1.1, 1.0)


def test_topics_are_rewritten_only_as_a_whole(spark):
    r = one(spark, a=C.route_topic(F.lit("x.y.trips")), b=C.route_topic(F.lit("lakehouse.trips")),
            c=C.route_topic(F.lit("x.y.z.trips")), d=C.route_topic(F.lit("plain")))
    assert (r.a, r.b, r.c, r.d) == ("taxi_cdc.trips", "taxi_cdc.trips", "x.y.z.trips", "plain")


def test_intervals_are_checked():
    for text in ("1 fortnight", "x days", "1 day; DROP TABLE t", ""):
        with pytest.raises(ValueError):
            C.interval(text)


# --- parameters -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize(
    ("name", "low", "high"),
    [("limit", 1, 1000), ("hours_back", 1, 168), ("zone_limit", 1, 500), ("days_back", 1, 30),
     ("hours_ahead", 1, 168), ("top_zones", 1, 100), ("minutes_back", 5, 240)],
)
def test_bounds(name, low, high):
    assert P.check_bound(name, low) == low and P.check_bound(name, high) == high
    for value in (low - 1, high + 1):
        with pytest.raises(ValueError):
            P.check_bound(name, value)


def test_bounds_are_enforced_by_the_serving_functions(spark, sf_dir):
    t, z = roles.trips_e(spark, sf_dir), roles.zones_c(spark, sf_dir)
    for call in (
        lambda: T.recent_trips(t, AS_OF, 169), lambda: T.recent_trips(t, AS_OF, 24, 1001),
        lambda: A.zone_metrics(t, z, "2024-01-01", AS_OF, 501), lambda: A.hourly_series(t, AS_OF, 31),
        lambda: S.forecast(t, z, AS_OF, 169), lambda: S.realtime_activity(t, z, AS_OF, 4),
        lambda: S.time_series(t, "tips", AS_OF), lambda: T.paginate(t, ["trip_id"], 0, 5),
    ):
        with pytest.raises(ValueError):
            call()


def test_composed_filter_with_nothing_keeps_everything(spark, sf_dir):
    t = roles.trips_e(spark, sf_dir)
    assert P.apply_filters(t).count() == t.count()
    assert P.apply_filters(t, zone_ids=[1, 2], fares=(None, 30)).count() == t.filter(
        "pickup_location_id IN (1, 2) AND fare_amount <= 30"
    ).count()


# --- changes --------------------------------------------------------------------------------------------------------

def broker(spark, values):
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1), v) for i, v in enumerate(values)], "offset bigint, timestamp timestamp, value string"
    )


def test_change_filter_is_parenthesised_and_null_safe(spark):
    after = '{"op":"%s","ts_ms":1,"after":{"id":1,"pickup_location_id":%s,"fare_amount":%s}}'
    values = [after % ("c", 5, 1.5), after % ("u", "null", 1.5), after % ("c", 5, "null"), after % ("c", 5, 0),
              after % ("r", 5, 2), '{"op":"d","ts_ms":1,"before":{"id":1},"after":null}', "{", None]
    assert [r.offset for r in W.trip_rows(broker(spark, values)).orderBy("offset").collect()] == [0, 4]


def test_zone_activity_takes_dropoffs_and_top_destination(spark):
    value = '{"op":"c","ts_ms":1,"after":{"id":%d,"vendor_id":1,"pickup_location_id":%d,"dropoff_location_id":%d,' \
            '"fare_amount":10,"total_amount":100}}'  # fmt: skip
    routes = [(1, 5), (1, 5), (1, 3), (3, 1), (5, 5), (5, 1)]
    rows = W.trip_rows(broker(spark, [value % (i, a, b) for i, (a, b) in enumerate(routes)]))
    got = W.zone_activity(W.trip_window_aggs(rows), W.window_dropoffs(rows)).collect()
    assert {r.zone_id: (r.pickup_count, r.dropoff_count, r.top_destination_zone) for r in got} == {
        1: (3, 2, 5), 3: (1, 1, 1), 5: (2, 3, 1)
    }
    assert {r.zone_id: round(r.activity_score, 6) for r in got}[1] == round(3 * 0.4 + 300 / 100 * 0.4 + 0.2, 6)


def test_deletes_keep_their_row_and_are_marked(spark):
    values = ['{"op":"d","ts_ms":1,"before":{"id":7,"fare_amount":3.5},"after":null,"source":{"db":"a","table":"b","ts_ms":9}}']
    r = X.flatten_change(X.parse_envelope(broker(spark, values))).first()
    assert (r.id, r.fare_amount, r["__deleted"], r["__op"], r["__source_ts_ms"]) == (7, 3.5, True, "d", 9)


def test_bad_records_are_set_aside(spark):
    row = '"after":{"id":1,"fare_amount":2}'
    values = [
        '{"op":"c","ts_ms":1,%s}' % row, '{"op":"c","ts', "[]", "null", None, '{"op":"x",%s}' % row, '{"ts_ms":2,%s}' % row,
        '{"op":"d","before":{"id":1},"after":null}', '{"op":"r"}', '{"op":"c","after":"no object"}', '{"op":"u","after":{"x":1}}',
    ]
    good, bad = X.split_bad(broker(spark, values))
    assert sorted(r.offset for r in good.collect()) == [0, 7]
    assert sorted(r.offset for r in bad.collect()) == [1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert good.columns == bad.columns == ["offset", "timestamp", "value"]


def test_same_millisecond_is_decided_by_offset(spark):
    log = spark.createDataFrame(
        [(1, 5, 10, "c", 1.0), (1, 5, 11, "u", 2.0), (1, 4, 12, "u", 3.0), (2, 1, 1, "c", 4.0), (2, 2, 2, "d", 4.0)],
        "id int, __source_ts_ms bigint, offset bigint, __op string, fare double",
    ).withColumn("__deleted", F.col("__op") == "d")
    assert [(r.id, r.fare) for r in X.current_state(log, "id").collect()] == [(1, 2.0)]


def test_updates_recompute_the_total(spark):
    base = spark.createDataFrame(
        [(1, 10.0, 1.0, None, 2.0, 0.0, 99.0, dt.datetime(2024, 1, 1)), (2, 5.0, 0.0, 0.0, 0.0, 0.0, 5.0, None)],
        "id int, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
        "total_amount double, updated_at timestamp",
    )
    updates = spark.createDataFrame(
        [(1, 3.0, dt.datetime(2024, 2, 1)), (1, 4.0, dt.datetime(2024, 2, 2))],
        "id int, tip_amount double, updated_at timestamp",
    )
    got = {r.id: (r.tip_amount, r.total_amount, r.updated_at) for r in X.apply_updates(base, updates).collect()}
    assert got == {1: (4.0, 15.0, dt.datetime(2024, 2, 2)), 2: (0.0, 5.0, None)}


# --- features -------------------------------------------------------------------------------------------------------

def test_lags_see_the_history_before_the_emitted_interval(spark, sf_dir):
    args = roles.trips_e(spark, sf_dir), roles.weather_h(spark, sf_dir), roles.zones_c(spark, sf_dir)
    whole = M.demand_features(*args, AS_OF, "30 days", "30 days")
    last = M.demand_features(*args, AS_OF, "30 days", "2 days")
    assert last.count() > 0
    assert last.exceptAll(whole).isEmpty()
    assert last.filter("historical_demand_1h_ago IS NULL").count() < last.count()


def test_grid_mode_has_every_hour(spark, sf_dir):
    args = roles.trips_e(spark, sf_dir), roles.weather_h(spark, sf_dir), roles.zones_c(spark, sf_dir)
    got = M.demand_features_ml(*args, AS_OF, "30 days", "1 day", mode="grid")
    zones = args[0].select("pickup_location_id").distinct().count()
    assert got.count() == zones * 25
    with pytest.raises(ValueError):
        M.demand_history(args[0], AS_OF, "30 days", "dense")


def test_the_last_hour_counts_whole(spark):
    times = [dt.datetime(2024, 1, 30, 22, 1), dt.datetime(2024, 1, 30, 23, 1), dt.datetime(2024, 1, 30, 23, 59, 59, 500_000)]
    trips = spark.createDataFrame([(5, t) for t in [*times, dt.datetime(2024, 1, 31)]], "pickup_location_id bigint, pickup_datetime timestamp")
    for at in ("2024-01-30 23:59:59", "2024-01-30 23:00:00", "2024-01-30 23:59:59.999999"):
        got = M.demand_history(trips, at, "1 day").collect()
        assert sorted((r.hour_timestamp.hour, r.demand_count) for r in got) == [(22, 1), (23, 2)], at


def test_calendars_and_nearby_demand(spark, sf_dir):
    args = roles.trips_e(spark, sf_dir), roles.weather_h(spark, sf_dir), roles.zones_c(spark, sf_dir)
    days = spark.createDataFrame([(dt.date(2024, 1, 1), 1.5)], "day date, event_factor double")
    got = M.demand_features(*args, AS_OF, "30 days", "30 days", holidays=days, events=days, nearby_km=2.0)
    first = F.to_date("prediction_datetime") == F.lit("2024-01-01").cast("date")
    assert got.filter(first & ~F.col("is_holiday")).count() == 0 < got.filter(first).count()
    assert got.filter(~first & (F.col("is_holiday") | (F.col("event_factor") != 1))).count() == 0
    assert {r[0] for r in got.filter(first).select("event_factor").distinct().collect()} == {1.5}
    assert got.count() == A.hourly_demand(args[0]).count()
    assert got.filter("nearby_zones_demand IS NULL").count() == 0


def test_unknown_zones_and_missing_weather_get_defaults(spark):
    trips = spark.createDataFrame(
        [(77, dt.datetime(2024, 1, 30, 5, 6))], "pickup_location_id bigint, pickup_datetime timestamp"
    )
    weather = spark.createDataFrame(
        [], "timestamp timestamp, weather_condition string, temperature_celsius double, humidity_percent double, "
            "wind_speed_kmh double"
    )
    zones = spark.createDataFrame(
        [(1, "airport", True, True)], "location_id bigint, zone_type string, is_tourist_area boolean, "
                                      "is_business_district boolean"
    )
    r = M.demand_features_ml(trips, weather, zones, AS_OF).first()
    assert (r.temperature_celsius, r.humidity_percent, r.wind_speed_kmh) == (20.0, 50.0, 5.0)
    assert (r.weather_condition_encoded, r.zone_type_encoded, r.rolling_std_7d) == (1.0, None, 1.0)
    assert (r.is_tourist_area_flag, r.demand_1h_ago, r.rolling_avg_7d, r.zone_popularity_score) == (0, 0, 0.0, 1.0)


def test_correlation_leaves_out_rows_without_history(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0, None), (2.0, 1.0, 1.0), (4.0, 2.0, 2.0), (6.0, 3.0, 3.0)], "d double, lag double, raw double"
    )
    pairs = {"c": ("d", "lag")}
    assert A.feature_correlation(df, pairs, "raw").first().c == pytest.approx(1.0)
    assert A.feature_correlation(df, pairs).first().c < 1.0


def test_forecast_repeats_and_stays_in_range(spark, sf_dir):
    t, z = roles.trips_e(spark, sf_dir), roles.zones_c(spark, sf_dir)
    a = S.forecast(t, z, AS_OF, 24, 0, seed=7)
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in S.forecast(t, z, AS_OF, 24, 0, seed=7).collect()]
    r = a.agg(F.min("confidence_score").alias("lo"), F.max("confidence_score").alias("hi"),
              F.max(F.abs(F.col("predicted_demand") - F.col("historical_avg"))).alias("off")).first()
    assert 0.7 <= r.lo < r.hi <= 0.95 and r.off <= 0.2 * 100
    assert {x[0] for x in a.select("weather_impact_factor").distinct().collect()} <= {0.8, 1.0, 1.2}


def test_seasonal_forecast_gives_one_row_per_zone_and_matching_hour(spark, sf_dir):
    t, z = roles.trips_e(spark, sf_dir), roles.zones_c(spark, sf_dir)
    f = S.forecast_seasonal(t, z, AS_OF, 168, 30)
    assert f.groupBy("location_id", "prediction_hour").count().filter("count > 1").count() == 0


def test_empty_day(spark, sf_dir):
    t, z = roles.trips_e(spark, sf_dir), roles.zones_c(spark, sf_dir)
    r = A.dashboard_stats(t, z, "2030-01-01").first()
    assert (r.total_trips, r.total_revenue, r.avg_fare, r.active_zones) == (0, 0.0, 0.0, 0)
    assert (r.peak_hour, r.top_zones) == ("N/A", [])


def test_keyset_pages_cover_the_listing_once(spark, sf_dir):
    t = roles.trips_e(spark, sf_dir).select("trip_id", "pickup_datetime")
    seen, after = [], None
    while True:
        page = T.page_after(t, "pickup_datetime", "trip_id", after, 300).collect()
        if not page:
            break
        seen += [r.trip_id for r in page]
        after = (page[-1].pickup_datetime, page[-1].trip_id)
    assert len(seen) == len(set(seen)) == t.count()


# --- quality --------------------------------------------------------------------------------------------------------

def test_quality_checks_find_planted_faults(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, None)], "id int, v double")
    assert D.not_empty(df) and not D.not_empty(df.limit(0))
    assert {r.column_name: r.n_missing for r in D.required(df, ["id", "v"]).collect()} == {"id": 0, "v": 2}
    with pytest.raises(ValueError):
        D.required(df, ["nope"])
    assert D.schema_diff(df, "id int, v string, w int") == [("v", "string", "double"), ("w", "int", None)]
    assert D.schema_report(df, "id int, v double").count() == 0
    assert D.same_rows(df, df) and not D.same_rows(df, df.union(df))
    spread = spark.range(1000).select((F.col("id") % 10).cast("double").alias("x")).union(
        spark.createDataFrame([(900.0,)], "x double")
    )
    assert [r.x for r in D.outliers(spread, ["x"]).collect()] == [900.0]
    assert [r.x for r in D.outliers_iqr(spread, "x").collect()] == [900.0]
    hours = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 5),) for h in (0, 1, 4)], "t timestamp")
    assert sorted(r[0].hour for r in D.missing_hours(hours, "t").collect()) == [2, 3]
    assert D.missing_hours(hours.limit(0), "t").count() == 0
    assert {r.window_start.hour: r.n_rows for r in D.rows_per_interval(hours, "t").collect()} == {0: 1, 1: 1, 4: 1}
