from datetime import date as D
from datetime import datetime as T

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from tallyworks.operators import change_log, claims, temporal
from tallyworks.sources import replace_partition

CUT = {"ranges": 4, "per_range": 4}


def versions(spark):
    return table(
        spark, "k int, label string, eff_date date, end_date date",
        (1, "a", D(2020, 1, 1), D(2020, 6, 30)), (1, "b", D(2020, 7, 1), D(3000, 1, 1)),
        (2, "c", D(2020, 3, 1), D(2020, 3, 31)), (None, "n", D(2020, 1, 1), D(3000, 1, 1)),
    )


def test_asof_dim_join(spark):
    fact = table(spark, "k int", (1,), (2,), (3,), (None,))
    got = temporal.asof_dim_join(fact, versions(spark), ["k"], "2020-06-30")
    assert set(rows(got)) == {(1, "a"), (2, None), (3, None), (None, None)}
    inner = temporal.asof_dim_join(fact, versions(spark), ["k"], "2020-03-31", how="inner")
    assert set(rows(inner)) == {(1, "a"), (2, "c")}


@pytest.mark.parametrize("options", [{}, CUT])
def test_asof_row_join_equals_range_join(spark, options):
    data = [(k, D(2020, m, d), i) for i, (k, m, d) in enumerate(
        [(1, 1, 1), (1, 6, 30), (1, 7, 1), (1, 12, 31), (2, 2, 29), (2, 3, 1), (2, 3, 31), (2, 4, 1), (3, 1, 1), (None, 5, 5)] + [(1, m, 15) for m in range(1, 13)]
    )]
    fact = table(spark, "k int, at date, id int", *data)
    got = temporal.asof_row_join(fact, versions(spark), ["k"], "at", **options)
    v = versions(spark).withColumnRenamed("k", "vk")
    want = fact.join(v, (F.col("k") == F.col("vk")) & F.col("at").between(F.col("eff_date"), F.col("end_date")), "left").select("k", "at", "id", "label")
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)
    assert temporal.asof_row_join(fact, versions(spark), ["k"], "at", how="inner", **options).count() == want.filter("label is not null").count()


def test_map_codes_compare_text(spark):
    df = table(spark, "d string", ("002",), ("MB.TD",), ("MN",), ("zz",), (None,))
    got = [r.region for r in temporal.map_codes(df, "d", claims.REGION_DEPARTMENTS, "", "region").collect()]
    # text codes must not fall into the first list because of a number in it
    assert got == ["Miền Bắc", "Miền Bắc", "Miền Nam", "", ""]
    long = table(spark, "code string, label string", ("002", "two"))
    assert [r.d for r in temporal.map_codes(df, "d", long, "none").orderBy("d").collect()].count("two") == 1


def test_milestones_count_to_the_end_of_the_day(spark):
    log = table(
        spark, "id int, action string, ts timestamp_ntz",
        (1, "A", T(2025, 1, 2, 10)), (1, "A", T(2025, 1, 2, 23, 59)), (1, "A", T(2025, 1, 3)), (1, "B", T(2025, 1, 1)),
    )
    spec = {"a": F.col("action") == "A", "c": F.col("action") == "C"}
    assert rows(temporal.milestones(log, ["id"], "ts", spec, "2025-01-02")) == [(1, T(2025, 1, 2, 23, 59), None)]


def test_patch_modes(spark):
    df = table(spark, "id int, v int", (1, 10), (2, None), (3, 30))
    src = table(spark, "id int, v int, n int", (1, 7, 1), (1, 8, 2), (2, 9, 1))
    get = lambda **k: dict(rows(temporal.patch_from(df, src, ["id"], ["v"], "n", **k)))
    assert get() == {1: 8, 2: 9, 3: None}
    assert get(mode="fill") == {1: 10, 2: 9, 3: 30}
    assert get(when=F.col("id") == 1) == {1: 8, 2: None, 3: 30}
    with pytest.raises(ValueError):
        get(mode="other")


def test_estimates_newest_wins_and_approval_breaks_ties(spark):
    est = table(
        spark, "id int, code string, amount double, at timestamp_ntz",
        (1, "B", 2.0, T(2025, 1, 1, 9)), (1, "A", 1.4, T(2025, 1, 1, 9)), (1, "A", 5.0, T(2025, 1, 2, 9)),
        (2, "A", 7.0, T(2025, 1, 5)), (3, "A", 1.0, T(2025, 2, 1)), (4, "A", 1.0, None),
    )
    app = table(
        spark, "id int, code string, amount double, done date",
        (1, "A", 9.0, D(3000, 1, 1)), (2, "A", 8.5, D(2025, 1, 5)), (2, "B", 1.0, D(2025, 1, 5)),
    )
    got = temporal.estimate_history(est, app, ["id"], "code", "amount", "at", "done", "2025-01-31")
    assert sorted(rows(got)) == [(1, D(2025, 1, 2), "5"), (2, D(2025, 1, 5), "9,1")]


def test_channel_fallback_postal_partner(spark):
    df = table(
        spark, "sale_channel_type string, custid_tong string, general_agency_channel string, sale_code string, custid_kt string, company_code string",
        ("D", "VNPOST", "G1", "S1", None, "C1"), ("D", "VNPOST", "G1", "S1", "K1", "C1"), ("K", "X", "G1", "S1", None, None), (None, None, None, None, None, None),
    )
    got = [tuple(r)[6:] for r in claims.channel_fallback(df).collect()]
    assert got == [
        ("VNPOST", "G1", "S1", "VNPOST", "G1", "S1"), ("VNPOST", "G1", "S1", "VNPOST", "C1", "K1"),
        ("KHAC", "KHAC", "KHAC", "X", "KHONG_KENH_KT", "KHONG_KENH_KT"),
        ("KHAC", "KHAC", "KHAC", "KHAC", "KHONG_KENH_KT", "KHONG_KENH_KT"),
    ]


def test_vip_label_falls_back_to_the_code(spark):
    df = table(spark, "vip string, code int", ("Gold", -41), (None, -41), (None, 0), (None, 5), (None, None))
    got = [r.vip for r in claims.vip_label(df, "vip", "code").collect()]
    assert got == ["Gold", "VIP 1 KT", "KH thông thường", "Không xác định", "Không xác định"]


def test_change_log_sees_a_return_to_an_old_state(spark):
    log = table(spark, "id int, row_hash string, fk_date date", (1, "A", D(2025, 1, 1)), (1, "B", D(2025, 1, 2)), (2, "X", D(2025, 1, 1)))
    snap = table(spark, "id int, row_hash string", (1, "A"), (2, "X"), (3, "N"))
    latest = change_log.change_log_append(log, snap, ["id"], as_of="2025-01-03")
    assert sorted(rows(latest)) == [(1, "A"), (3, "N")]
    either = change_log.change_log_append(log, snap, ["id"], as_of="2025-01-03", compare="any")
    assert rows(either) == [(3, "N")]
    state = change_log.refresh_latest(change_log.latest_state(log, ["id"]), latest.withColumn("fk_date", F.lit(D(2025, 1, 3))), ["id"])
    assert {r.id: r.row_hash for r in state.collect()} == {1: "A", 2: "X", 3: "N"}


def test_append_day_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "log")
    one = table(spark, "id int, row_hash string", (1, "A"), (2, "B"))
    two = table(spark, "id int, row_hash string", (1, "A"), (2, "C"))
    for day, snap in (("2025-01-01", one), ("2025-01-02", two), ("2025-01-02", two), ("2025-01-03", two), ("2025-01-01", one)):
        change_log.append_day(spark, path, snap, ["id"], day)
    got = sorted((r.id, r.row_hash, str(r.fk_date)) for r in spark.read.parquet(path).collect())
    assert got == [(1, "A", "2025-01-01"), (2, "B", "2025-01-01"), (2, "C", "2025-01-02")]


def test_replace_partition_clears_an_empty_day(spark, tmp_path):
    path = str(tmp_path / "t")
    df = table(spark, "d string, v int", ("a", 1), ("b", 2))
    for v in ("a", "b"):
        replace_partition(df, path, "d", v)
    replace_partition(df.filter("v > 1"), path, "d", "a")
    assert [(r.d, r.v) for r in spark.read.parquet(path).collect()] == [("b", 2)]


def claim_tables(spark):
    """Two claims of one unit, one of them with two insured objects, and a claim without clauses."""
    far, early = D(3000, 1, 1), D(2020, 1, 1)
    unit = ("U", )
    of = lambda schema, *data: table(spark, "unit_code string, claim_id int, " + schema, *[(*unit, *r) for r in data])
    ref = lambda schema, *data: table(spark, schema + ", eff_date date, end_date date", *[(*r, early, far) for r in data])
    money = "kind string, amount_lcy decimal(18,2), system_date date, eff_date date, end_date date"
    from decimal import Decimal as N

    return {
        "claims": of(
            "manage_unit_code string, policy_id int, category string, department_code string, claim_detail_status int, call_center_id int, "
            "garage_code string, claim_approved_date date, eff_date date, end_date date",
            (1, "U", 7, "XE", "000", 22, 1, "G", D(2025, 1, 5), early, far), (2, "U", 7, "2B", "MN", 1, 2, None, far, early, far),
            (3, "U", 7, "XE", "MN", 1, 2, None, far, early, far), (1, "U", 7, "XE", "000", 3, 1, "G", far, D(2019, 1, 1), D(2019, 12, 31)),
        ),
        "clauses": of("object_id int, business_type_code string, compensation_amount double", (1, 10, "B", 5.0), (1, 10, "A", 6.4), (1, 11, "C", 7.0), (2, 20, "A", 1.0)),
        "estimates": of(
            "business_type_code string, compensation_amount double, requested_at timestamp_ntz",
            (1, "A", 3.0, T(2025, 1, 5, 8)), (2, "B", 4.0, T(2025, 1, 2)), (2, "A", 9.0, T(2025, 1, 2)), (2, "A", 2.0, T(2025, 1, 1)), (2, "A", 1.0, T(2026, 1, 1)),
        ),
        "log": of("action string, approve_type string, created_date timestamp_ntz", (1, "V_DUYET_DG_BL", "D", T(2025, 1, 3, 9)), (2, "V_DUYET_BL", "D", T(2025, 1, 3)), (2, "M_CHUYEN_C", "C", T(2027, 1, 1))),
        "prices": of(
            "proposed_at timestamp_ntz, price_approve_amt int, replacement_amt int, special_replacement_amt int, repair_amt int, repainting_amt int, labor_amt int, "
            "lifting_amt int, compensation_amt int, risk_shared_amt int, deductible_quantity int",
            (1, T(2025, 1, 1), 5, 1, 2, 3, 4, 5, 6, 7, 8, 2), (1, T(2025, 1, 2), 5, 10, 0, 0, 0, 0, 6, 7, 8, 3), (1, T(2025, 1, 3), 0, 99, 0, 0, 0, 0, 6, 7, 8, 9),
        ),
        "car_claims": of("user string, claims_adjuster string, product_type string, eff_date date, end_date date", (1, None, "adj", "XE", early, far), (2, "u", "a", "2B", early, far)),
        "garage_debt": of(money, (1, "T", N(5), D(2025, 1, 2), early, far), (1, "T", N("6.5"), D(2025, 1, 1), early, far), (1, "C", N(4), D(2025, 1, 1), early, far), (1, "C", N(40), D(2025, 1, 1), early, early)),
        "advances": of(money, (1, "C", N(8), D(2025, 1, 2), early, early), (1, "T", N(3), D(2025, 1, 2), early, far), (1, "T", N(2), D(2025, 1, 2), early, far)),
        "garage_payments": of(money, (1, "x", N(8), D(2025, 1, 2), early, far), (1, "x", N(1), D(2025, 1, 4), early, far)),
        "customer_payments": of(money.replace("system_date", "created_date"), (2, "x", N(8), D(2025, 1, 2), early, early)),
        "policies": ref("unit_code string, policy_id int, policy_number string, custid string, custid_kt string, sale_channel_type string, sale_code string, vip_code int", ("U", 7, "P7", "C1", "K1", "D", "S1", -41)),
        "certificates": ref("unit_code string, policy_id int, certificate_id int, certificate string, certificate_effective_date date, certificate_effective_time string", ("U", 7, 10, "CT", D(2025, 1, 1), "8H30")),
        "customers": ref("unit_code string, custid string, custid_tong string, company_code string", ("U", "K1", "GROUP", "CO"), ("U", "G", "GARAGES", "CG")),
        "units": ref("unit_code string, unit_name string", ("U", "Unit")),
        "departments": ref("unit_code string, department_code string, department_name string", ("U", "000", "Dep")),
        "agencies": ref("unit_code string, agency_id string, general_agency_channel string", ("U", "S1", "GA")),
        "vip_customers": ref("unit_code string, custid string, vip_customer_type string", ("U", "C9", "Gold")),
        "calls": table(spark, "unit_code string, call_center_id int, valid int, created_date timestamp_ntz", ("U", 1, 1, T(2025, 1, 1, 7)), ("U", 1, 0, T(2025, 1, 9))),
    }


def test_snapshot_folds_all_sources_of_a_claim(spark):
    wide = claims.claim_snapshot(claim_tables(spark), "2025-01-31")
    got = {(r.claim_id, r.certificate_id): r for r in wide.collect()}
    assert set(got) == {(1, 10), (1, 11), (2, 20)}
    one, two = got[1, 10], got[2, 20]
    assert (one.business_type_code, got[1, 11].business_type_code) == ("A,B", "C") and one.compensation_amount_lcy == "6,5,7"
    assert two.compensation_amount_lcy == "9,4" and two.price_make_date is None
    assert (one.total_repair_amt, one.lifting_amt, one.number_of_deduction, two.total_repair_amt, two.number_of_deduction) == (10, 6, 3, None, 0)
    assert (one.maker_user, two.maker_user) == ("adj", None)
    assert (one.garage_advance_amt, one.garage_advance_date, one.garage_advance_recovery_amt) == ("7;5", "2025-01-01;2025-01-02", 4)
    assert (one.customer_advance_amt, one.customer_advance_recovery_amt, two.customer_advance_amt) == ("8", 5, None)
    assert (one.garage_payment_amt, one.garage_payment_date, two.customer_payment_amt) == (9, D(2025, 1, 4), None)
    assert (one.guarantee_date, two.guarantee_date) == (T(2025, 1, 3, 9), None)
    assert (one.custid_tong, one.general_sale_channel, two.custid_tong) == ("GARAGES", "GROUP", None)
    assert (one.vip_customer_type, one.region, one.claim_detail_status_name) == ("VIP 1 KT", "Miền Bắc", "Đã thanh toán")
    assert (one.certificate_effective_date, one.call_date) == (T(2025, 1, 1, 8, 30), T(2025, 1, 1, 7))
    assert len({r.row_hash for r in got.values()}) == 3 and wide.columns == [*claims.RECORD, "row_hash", "fk_date"]


def test_fingerprint_changes_with_any_source(spark):
    sources = claim_tables(spark)
    before = {(r.claim_id, r.certificate_id): r.row_hash for r in claims.claim_snapshot(sources, "2025-01-31").collect()}
    later = table(spark, sources["prices"].schema, ("U", 2, T(2025, 1, 9), 1, 1, 1, 1, 1, 1, 1, 1, 1, 1))
    sources["prices"] = sources["prices"].unionByName(later)
    after = {(r.claim_id, r.certificate_id): r.row_hash for r in claims.claim_snapshot(sources, "2025-01-31").collect()}
    assert {k for k in after if after[k] != before[k]} == {(2, 20)}


def test_range_of_claims(spark):
    got = claims.claim_snapshot(claim_tables(spark), "2025-01-31", claim_ids=(2, 3))
    assert [(r.claim_id, r.compensation_amount_lcy) for r in got.collect()] == [(2, "9,4")]


def test_fold_exchanges_the_claim_key_once(spark):
    folded = claims.claim_fold(claims.claim_entries(claim_tables(spark), "2025-01-31"))
    plan = folded._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    by_claim = [line for line in plan.splitlines() if "Exchange hashpartitioning(unit_code" in line]
    by_claim = [line for line in by_claim if line.split("hashpartitioning(")[1].count("#") == 2]
    assert len(by_claim) == 1 and "Union" in plan and "Join" not in plan


def test_snapshot_keeps_one_row_per_claim_and_object(spark, data_dir):
    from tallyworks.plans.claims import AS_OF, claim_sources
    from tallyworks.sources import Tables

    wide = claims.claim_snapshot(claim_sources(Tables(spark, data_dir)), AS_OF).cache()
    assert wide.count() == wide.select("claim_id", "certificate_id").distinct().count() > 0
    assert wide.filter("row_hash is null or length(row_hash) != 32").count() == 0
