from frames import month, route, routes, rows
from pyspark.sql import functions as F

from skyledger.operators.family import family_frame
from skyledger.plans import churn, destinations, families, hubs, gold
from skyledger.plans import routes as r
from skyledger.sources import driver_tables as d

SF = "/root/testdata/sf0.001"


def test_both_directions_share_a_route_and_headline_window(spark):
    data = [route(n, "A", "X", "Y", 100, 80) for n in range(24)] + [route(23, "B", "Y", "X", 100, 20)]
    m = r.route_monthly(routes(spark, data))
    assert rows(r.route_headline(m), "a", "b", "carriers", "passengers_12m", "load_factor_12m") == [("X", "Y", 2, 980, 100 * 980 / 1300)]
    assert r.route_headline(r.route_monthly(routes(spark, data), both=False)).count() == 2


def test_all_selected_is_the_sum_of_carriers_and_null_names_drop(spark):
    data = [route(0, "A", "X", "Y", 100), route(0, "B", "X", "Y", 50), route(0, "C", "X", "Y", 9, carrier_name=None)]
    lf = r.route_load_factor(r.route_monthly(routes(spark, data)))
    assert rows(lf, "carrier_name", "seats") == [("A Air", 100), ("All selected", 150), ("B Air", 50)]


def test_share_gaps_sum_to_zero_and_agree_in_sign(spark):
    gaps = r.share_gap(r.route_monthly(gold.route_carrier_month(d.segment(spark, SF)), d.families(spark)))
    sums = gaps.groupBy("a", "b").agg(F.sum("share_gap_pp").alias("s")).filter("abs(s) > 1e-9")
    signs = gaps.filter("abs(lf_gap_pp) > 1e-9 and signum(lf_gap_pp) <> signum(share_gap_pp)")
    assert sums.count() == 0 and signs.count() == 0
    zero = r.share_gap(r.route_monthly(routes(spark, [route(0, "A", "X", "Y", 0), route(0, "B", "X", "Y", 10)])))
    assert rows(zero, "carrier") == [("B",)]


def test_spokes_need_a_position_and_take_each_hubs_last_month(spark):
    data = [route(0, "A", "X", "Y", 10), route(1, "A", "X", "Z", 20), route(1, "A", "X", "Q", 5, dest_lat=None), route(0, "A", "W", "Y", 7)]
    assert rows(hubs.spokes(routes(spark, data)), "hub", "dest", "seats") == [("W", "Y", 7), ("X", "Z", 20)]
    assert rows(hubs.spokes(routes(spark, data), month=month(0)), "hub", "dest") == [("W", "Y"), ("X", "Y")]


def test_performers_floor_self_loops_and_unknown_country(spark):
    keep = [route(n, "A", "X", "Y", 600, 300, dest_country=None, dest_city=None) for n in range(3)]
    short = [route(n, "B", "X", "Y", 900) for n in range(2)]
    loop = [route(n, "A", "X", "X", 900) for n in range(5)]
    small = [route(n, "C", "X", "Y", 499) for n in range(5)]
    abroad = [route(n, "D", "X", "Y", 500, 100) for n in range(4)]
    data = routes(spark, keep + short + loop + small + abroad)
    assert rows(destinations.qualifying_routes(data), "carrier", "domestic", "months", "empty_seats") == [("A", True, 3, 900), ("D", False, 4, 1600)]
    assert rows(destinations.route_performers(data), "carrier", "side") == [("A", "best"), ("D", "worst")]
    assert destinations.route_performers(data, "Domestic").count() == 0  # a single route is no ranking


def test_momentum_compares_matching_calendar_months(spark):
    data = [route(n, "A", "X", "Y", 1000, 500) for n in range(12)] + [route(n, "A", "X", "Y", 1000, 700) for n in range(18, 24)]
    data += [route(n, "B", "X", "Y", 1000, 500) for n in range(24)]
    out = destinations.yoy_momentum(routes(spark, data))
    assert rows(out, "carrier", "months", "seats_mo", "delta_pp", "side") == [("A", 6, 1000.0, 20.0, "improving"), ("B", 12, 1000.0, 0.0, "declining")]
    unnamed = routes(spark, [{**x, "dest_city": None} for x in data])
    assert destinations.yoy_momentum(unnamed).count() == 0


def test_new_and_dropped_routes(spark):
    data = [route(n, "A", "X", "Y", 501, 100) for n in (20, 21)] + [route(n, "B", "X", "Y", 500) for n in (3, 5, 7)]
    data += [route(23, "C", "X", "Y", 9000), route(22, "D", "X", "Y", 600), route(5, "D", "X", "Y", 600)]
    out = destinations.new_dropped_routes(routes(spark, data))
    assert rows(out, "carrier", "change", "seats_mo", "months", "lf_pct", "n_routes") == [("A", "new", 501.0, 2, 20.0, 1), ("B", "dropped", 500.0, 3, 50.0, 1)]


def test_top_destinations_lump_the_tail(spark):
    data = [route(0, f"C{i:02d}", "X", "Y", 100 - i) for i in range(12)] + [route(0, "C00", "X", f"Z{i:02d}", i) for i in range(20)]
    out = destinations.top_destinations_by_carrier(routes(spark, data))
    assert out.select("dest").distinct().count() == 15
    assert rows(out.filter("carrier_name = 'Other'"), "dest", "seats") == [("Y", 90 + 89)]


def pair_months(spark, months, floor=500):
    return churn.route_churn(routes(spark, [route(n, "A", "X", "Y", 600) for n in months]), None, floor, horizon=month(200), since=month(0))


def test_twelve_month_steps_are_no_gap_thirteen_are(spark):
    assert rows(pair_months(spark, [0, 12]), "year", "added", "ended") == [(2000, 1, 0), (2001, 0, 1)]
    assert rows(pair_months(spark, [0, 13]), "year", "added", "ended") == [(2000, 1, 1), (2001, 1, 1)]


def test_churn_default_horizon_and_first_year(spark):
    data = [route(n, "A", "X", "Y", 600) for n in range(0, 15)] + [route(n, "A", "P", "Q", 600) for n in range(14, 36)]
    assert rows(churn.route_churn(routes(spark, data), None), "year", "added", "ended") == [(2001, 1, 1), (2002, 0, 0)]


def test_churn_floor_is_on_the_pair_and_long_form_is_signed(spark):
    data = [route(0, "A", "X", "Y", 300), route(0, "A", "Y", "X", 300), route(0, "A", "P", "Q", 499), route(0, "A", "X", "X", 999)]
    out = churn.route_churn(routes(spark, data), None, 500, horizon=month(24), since=month(0))
    assert rows(churn.churn_long(out), "what", "n") == [("added", 1), ("ended", -1)]


def test_moves_of_a_family_and_a_renamed_city(spark):
    fam = family_frame(spark, [("A", "F", "Eff", None, ""), ("B", "F", "Eff", "2000-05-01", "")])
    added = [route(n, "A", "X", "Y", 600, 300) for n in (20, 21)] + [route(21, "B", "Y", "X", 600, 300)]
    kept = [route(n, "A", "P", "Q", 900) for n in range(24)]
    renamed = [route(n, "A", "R", "S", 700, dest_city="Old, X" if n < 12 else "New, X") for n in range(24)]
    out = churn.recent_moves(routes(spark, added + kept + renamed), fam)
    assert rows(out, "move", "a", "cities", "operators", "months", "seats_mo", "lf_pct") == [
        ("added", "R", "R City - New", "A", 12, 700.0, 50.0),
        ("added", "X", "X City - Y City", "A, B", 2, 900.0, 50.0),
        ("ended", "R", "R City - Old", "A", 12, 700.0, 50.0),
    ]


def test_family_members_in_merger_order(spark):
    fam = family_frame(spark)
    fm = spark.createDataFrame([("DL", month(0), 5), ("AS", month(0), 9), ("DL", month(11), 1)], "family string, flight_month date, seats bigint")
    out = families.family_summary(fam, fm).collect()
    assert [(x.family, x.seats_12m) for x in out[:2]] == [("AS", 9), ("DL", 6)] and out[2].seats_12m is None
    assert out[0].members == "AS + VX + HA" and {x.family: x.members for x in out}["AA"] == "AA + TW + HP + US"
    assert [x.carrier for x in families.merger_timeline(fam).filter("family = 'UA'").collect()] == ["UA", "CO", "CS"]
    assert rows(families.merger_markers(fam, "2010-01-01", "2012-12-01"), "family", "carriers") == [("DL", "NW"), ("UA", "CO/CS")]


def test_family_headline(spark):
    fam = family_frame(spark, [("A", "F", "Eff", None, ""), ("B", "F", "Eff", "2000-05-01", "")])
    fm = spark.createDataFrame([("F", month(n), 100, 50, n) for n in range(20)], "family string, flight_month date, seats bigint, passengers bigint, routes_served bigint")
    cm = spark.createDataFrame([("A", month(19)), ("B", month(5))], "carrier string, flight_month date")
    out = families.family_headline(fm, cm, fam)
    assert rows(out, "family", "member_codes", "still_flying", "seats_12m", "routes_now", "load_factor_12m") == [("F", 2, 1, 1200, 19, 50.0)]


def test_members_trend_starts_at_the_twelfth_month(spark):
    fam = family_frame(spark, [("A", "F", "Eff", None, "")])
    cm = spark.createDataFrame([("A", "Aye", month(n), 2_000_000) for n in range(13)], "carrier string, carrier_name string, flight_month date, seats bigint")
    assert rows(families.family_members_trend(cm, fam), "flight_month", "seats_millions") == [(month(11), 2.0), (month(12), 2.0)]


def test_the_last_month_of_a_family_counts_self_loops(spark):
    data = [route(n, "A", "X", "Y", 900) for n in (4, 5)] + [route(17, "A", "X", "X", 10)]
    assert rows(churn.recent_moves(routes(spark, data), None), "move", "a", "b") == [("ended", "X", "Y")]


def test_named_carriers_come_from_all_carriers(spark):
    data = [route(0, f"C{i:02d}", "X", "Y", 100 - i) for i in range(12)]
    out = destinations.top_destinations_by_carrier(routes(spark, data), carriers=["C01", "C11"])
    assert rows(out, "carrier_name", "seats") == [("C01 Air", 99), ("Other", 89)]
