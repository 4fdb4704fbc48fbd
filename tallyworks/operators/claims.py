"""The wide daily record of a claim."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import assemble_timestamp
from tallyworks.operators.change_log import with_fingerprint
from tallyworks.operators.ordering import spread
from tallyworks.operators.temporal import asof_dim_join, is_open, map_codes, patch_from, valid_on

# Department codes per region.
REGION_DEPARTMENTS = {
    "Miền Bắc": (
        "000", "090", "MB.TD", "002", "0030", "050", "051", "093", "005", "006", "013", "014", "015",
        "019", "021", "022", "023", "030", "034", "039", "040", "043", "044", "090.P1", "090.P2",
        "090.P3", "090.P4", "090.P5", "090.P6", "090.TTL",
    ),
    "Miền Nam": (
        "MN", "MN.TD", "091", "0010", "004", "007", "008", "009", "010", "011", "012", "017", "018",
        "033", "035", "046", "049", "052", "053", "091.P1", "091.P2", "091.P3", "091.P5", "091.P7",
        "091.TTL", "091.P9", "042",
    ),
}

# Name of each claim status.
STATUS_NAMES = {
    "Đã hủy": (1,),
    "Giám định chi tiết": (3,),
    "Trình công nhận giá": (4,),
    "Check công nhận giá": (5,),
    "Chờ duyệt Công nhận giá": (6,),
    "Đã duyệt công nhận giá": (7,),
    "Trình duyệt giá": (8,),
    "Check duyệt giá": (9,),
    "Chờ duyệt duyệt giá": (10,),
    "Đã duyệt duyệt giá": (11,),
    "Trình bảo lãnh": (12,),
    "Đã bảo lãnh": (13,),
    "Trình đề nghị thanh toán": (14,),
    "Check đề nghị thanh toán": (15,),
    "Chờ duyệt đề nghị thanh toán": (16,),
    "Đã duyệt đề nghị thanh toán": (17,),
    "Đã chuyển thông tin ĐNTT": (18,),
    "Chờ duyệt ngoại lệ": (19,),
    "Chờ thanh toán": (20,),
    "Chờ xử lý lỗi chi tiền qua bank": (21,),
    "Đã thanh toán": (22,),
    "Từ chối thanh toán": (23,),
}

# Customer class by class code, used when the dimension has no name.
VIP_NAMES = {
    "VIP 1 KT": (-41,),
    "VIP 1 KKT": (-40,),
    "VIP 2 KT": (-31,),
    "VIP 2 KKT": (-30,),
    "VIP 1 KT P.KHL": (-21,),
    "VIP 1 KKT P.KHL": (-20,),
    "VIP 2 KT P.KHL": (-11,),
    "VIP 2 KKT P.KHL": (-10,),
    "KH thông thường": (0,),
    "KH xấu": (10,),
    "Đ.lý/Môi giới VIP - Các đối tượng/KH đ.lý/Môi giới này khai thác được coi là VIP": (20,),
    "Kênh khai thác VIP - Các đối tượng/KH kênh này khai thác được coi là VIP": (30,),
}
VIP_UNKNOWN = "Không xác định"

# Defaults of the sales channel tiers, the direct channel and the postal partner.
OTHER_CHANNEL, NO_CHANNEL, AGENCY_TYPE, POSTAL = "KHAC", "KHONG_KENH_KT", "D", "VNPOST"

# Actions of the approval log.
GUARANTEE_ACTIONS = ("V_DUYET_DG_BL", "V_DUYET_BL")
CAR_CATEGORIES = ("XE", "XEL")


# Kinds of advances and garage debts (paid out, taken back) and products of car claims.
GARAGE_PAID, GARAGE_BACK, CUSTOMER_PAID, CUSTOMER_BACK = "T", "C", "C", "T"

# Columns of the record, in the order in which they enter the fingerprint.
RECORD = (
    "claim_id claim_no policy_id policy_number certificate_id certificate business_type_code region "
    "unit_code manage_unit_code unit_name department_code department_name vip_customer_type "
    "general_agency tier_2_agency tier_3_agency general_sale_channel tier_2_sale_channel tier_3_sale_channel "
    "custid fee_payment_date incident_date notified_date event_code system_date assessment_date "
    "garage_code garage_name motor_make motor_model_code motor_model production_year "
    "license_plate chassis_number motor_owner_name number_of_deduction claim_detail_status claim_detail_status_name "
    "price_make_date price_check_date price_validate_date "
    "price_approval_make_date price_approval_check_date price_approval_validate_date "
    "payment_require_make_date payment_require_check_date payment_require_validate_date "
    "claim_approved_date maker_user tier1_checker_user tier2_checker_user validate_user compensation_amount_lcy "
    "custid_tong certificate_effective_date call_date guarantee_date "
    "garage_payment_amt garage_payment_date customer_payment_amt customer_payment_date "
    "total_repair_amt lifting_amt compensation_amt risk_shared_amt covered_repair_amt covered_lifting_amt "
    "customer_advance_amt customer_advance_date customer_advance_recovery_amt "
    "garage_advance_amt garage_advance_date garage_advance_recovery_amt total_recovery_amt"
).split()

CLAIM = ["unit_code", "claim_id"]


def milestone_spec(log: str = "") -> dict[str, Column]:
    """Condition of each named step of the approval log, whose fields may lie in a struct column."""
    at = f"{log}." if log else ""
    action, kind = F.col(f"{at}action"), F.col(f"{at}approve_type")
    return {
        "price_make_date": (action == "M_CHUYEN_C") & (kind == "C"),
        "price_check_date": (action == "C_CHUYEN_V") & (kind == "C"),
        "price_validate_date": (action == "V_DUYET") & (kind == "C"),
        "price_approval_make_date": (action == "M_CHUYEN_C") & (kind == "D"),
        "price_approval_check_date": (action == "C_CHUYEN_V") & (kind == "D"),
        "price_approval_validate_date": action.isin("V_DUYET", "V_DUYET_DG_BL") & (kind == "D"),
        "payment_require_make_date": action == "M_TRINH_C_DNTT",
        "payment_require_check_date": action == "C_CHUYEN_V_DNTT",
        "payment_require_validate_date": action == "DUYET_QDINH",
    }


def channel_fallback(df: DataFrame) -> DataFrame:
    """Sales channel tiers. Agency tiers are known only for policies sold by agencies; for the
    postal partner without its own customer the sales tiers fall back to the agency tiers."""
    by_agency = F.col("sale_channel_type") == AGENCY_TYPE

    def agency(value: Column) -> Column:
        return F.when(by_agency, value).otherwise(OTHER_CHANNEL)

    parent = F.col("custid_tong")
    second, third = agency(F.col("general_agency_channel")), agency(F.col("sale_code"))
    postal = (agency(parent) == POSTAL) & F.col("custid_kt").isNull()
    return df.withColumns(
        {
            "general_agency": F.coalesce(agency(parent), F.lit(OTHER_CHANNEL)),
            "tier_2_agency": F.coalesce(second, F.lit(OTHER_CHANNEL)),
            "tier_3_agency": F.coalesce(third, F.lit(OTHER_CHANNEL)),
            "general_sale_channel": F.coalesce(parent, F.lit(OTHER_CHANNEL)),
            "tier_2_sale_channel": F.coalesce(
                F.when(postal, second).otherwise(F.col("company_code")), F.lit(NO_CHANNEL)
            ),
            "tier_3_sale_channel": F.coalesce(
                F.when(postal, third).otherwise(F.col("custid_kt")), F.lit(NO_CHANNEL)
            ),
        }
    )


def vip_label(df: DataFrame, name: str, code: str) -> DataFrame:
    """Class name of the dimension, else the name of the class code."""
    labelled = map_codes(df, code, VIP_NAMES, VIP_UNKNOWN, "__vip")
    return labelled.withColumn(name, F.coalesce(F.col(name), F.col("__vip"))).drop("__vip")


def _amount(column: str) -> Column:
    return F.round(column, 0).cast("bigint")


def claim_entries(sources: Mapping[str, DataFrame], as_of, claim_ids: tuple | None = None) -> DataFrame:
    """All rows about claims under each other: unit_code, claim_id and one struct column per kind of
    row, of which one is filled. Versions are cut to the day and ranges of claims pushed to every
    source. Rows of one object, and of one request, are joined to one text first, each by its own
    key, so that a claim with very many of them is spread."""
    day = F.lit(as_of).cast("date")

    def of(name: str) -> DataFrame:
        rows = sources[name]
        return rows if claim_ids is None else rows.filter(F.col("claim_id").between(*claim_ids))

    claims = valid_on(of("claims"), as_of)
    clauses = of("clauses").groupBy(*CLAIM, "object_id").agg(
        F.collect_list(F.struct("business_type_code", _amount("compensation_amount").alias("amount"))).alias("parts")
    )
    codes = F.array_sort(F.transform("parts", lambda p: p["business_type_code"]))
    estimates = (
        of("estimates")
        .filter(F.to_date("requested_at") <= day)
        .groupBy(*CLAIM, "requested_at")
        .agg(F.collect_list(F.struct("business_type_code", _amount("compensation_amount").alias("amount"))).alias("parts"))
    )
    asked = F.struct(
        F.to_date("requested_at").alias("change_date"), F.col("requested_at").cast("timestamp_ntz").alias("at"), _amounts("parts").alias("text")
    )
    price = ["replacement_amt", "special_replacement_amt", "repair_amt", "repainting_amt", "labor_amt"]
    approved = F.struct(
        "proposed_at", reduce(Column.__add__, [F.col(c) for c in price]).alias("total_repair_amt"),
        "lifting_amt", "compensation_amt", "risk_shared_amt", "deductible_quantity",
    )
    # Advances show all that was paid; of what was taken back only the versions of the day count.
    live = (F.col("eff_date") <= day) & (F.col("end_date") >= day)
    money = F.struct(F.col("kind"), F.struct("system_date", _amount("amount_lcy").alias("amount")).alias("paid"), F.when(live, F.col("amount_lcy")).alias("live"))
    kinds = {
        "claim": claims.select(*CLAIM, F.struct(*[c for c in claims.columns if c not in CLAIM]).alias("claim")),
        "object": clauses.select(*CLAIM, F.struct(F.col("object_id").alias("certificate_id"), F.array_join(codes, ",").alias("codes"), "parts").alias("object")),
        "asked": estimates.select(*CLAIM, asked.alias("asked")),
        "log": of("log").filter(F.to_date("created_date") <= day).select(*CLAIM, F.struct("action", "approve_type", "created_date").alias("log")),
        "price": of("prices").filter(F.col("price_approve_amt") != 0).select(*CLAIM, approved.alias("price")),
        "car": valid_on(of("car_claims"), as_of).filter(F.col("product_type").isin(*CAR_CATEGORIES))
        .select(*CLAIM, F.struct(F.coalesce("user", "claims_adjuster").alias("maker_user")).alias("car")),
        "garage": of("garage_debt").select(*CLAIM, money.alias("garage")),
        "customer": of("advances").select(*CLAIM, money.alias("customer")),
        "garage_paid": valid_on(of("garage_payments"), as_of).select(*CLAIM, F.struct("amount_lcy", F.to_date("system_date").alias("date")).alias("garage_paid")),
        "customer_paid": valid_on(of("customer_payments"), as_of).select(*CLAIM, F.struct("amount_lcy", F.to_date("created_date").alias("date")).alias("customer_paid")),
    }
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds.values())


def _amounts(parts: str | Column) -> Column:
    """Amounts in the order of their codes, as one text."""
    texts = F.transform(F.array_sort(parts), lambda p: p["amount"].cast("string"))
    return F.nullif(F.array_join(texts, ","), F.lit(""))


def claim_fold(entries: DataFrame) -> DataFrame:
    """One row per claim from its rows of all kinds, in one aggregation; lists are kept where the record
    shows all of them. Sums, newest times and newest values are formed in the map tasks first; large
    inputs are dealt by claim before that (``spread``), so a task's share does not grow, but all rows of a
    claim then go to one task."""
    by_log = {name: F.max(F.when(hit, F.col("log.created_date"))).alias(name) for name, hit in milestone_spec("log").items()}
    guaranteed = F.col("log.action").isin(*GUARANTEE_ACTIONS)
    folded = spread(entries, CLAIM).groupBy(*CLAIM).agg(
        F.max("claim").alias("claim"),
        F.collect_list("object").alias("objects"),
        F.max("asked").alias("asked"),
        *by_log.values(),
        F.max(F.when(guaranteed, F.col("log.created_date"))).alias("guaranteed"),
        F.max("price").alias("price"),
        F.max("car.maker_user").alias("maker_user"),
        F.collect_list(F.when(F.col("garage.kind") == GARAGE_PAID, F.col("garage.paid"))).alias("garage_advances"),
        F.collect_list(F.when(F.col("customer.kind") == CUSTOMER_PAID, F.col("customer.paid"))).alias("customer_advances"),
        F.sum(F.when(F.col("garage.kind") == GARAGE_BACK, F.col("garage.live"))).alias("garage_advance_recovery_amt"),
        F.sum(F.when(F.col("customer.kind") == CUSTOMER_BACK, F.col("customer.live"))).alias("customer_advance_recovery_amt"),
        F.sum("garage_paid.amount_lcy").alias("garage_payment_amt"),
        F.max("garage_paid.date").alias("garage_payment_date"),
        F.sum("customer_paid.amount_lcy").alias("customer_payment_amt"),
        F.max("customer_paid.date").alias("customer_payment_date"),
    )
    known = folded.filter(F.col("claim").isNotNull() & (F.size("objects") > 0))
    settled = ~is_open("claim.claim_approved_date")
    own = _amounts(F.flatten(F.transform("objects", lambda o: o["parts"])))
    # An approval counts from its day on, and before a request of the same day.
    late = F.to_date("claim.claim_approved_date") >= F.coalesce(F.col("asked.change_date"), F.to_date("claim.claim_approved_date"))
    newest = F.when(settled & late, own).otherwise(F.col("asked.text"))

    def lists(name: str) -> tuple[Column, Column]:
        rows = F.array_sort(F.col(name))
        text = [F.transform(rows, lambda p: f(p).cast("string")) for f in (lambda p: p["amount"], lambda p: F.to_date(p["system_date"]))]
        return tuple(F.nullif(F.array_join(t, ";"), F.lit("")) for t in text)

    garage, customer = lists("garage_advances"), lists("customer_advances")
    price = ["total_repair_amt", "lifting_amt", "compensation_amt", "risk_shared_amt"]
    car = F.col("claim.category").isin(*CAR_CATEGORIES)
    keep = [c for c in folded.columns if c not in ("claim", "objects", "asked", "guaranteed", "price", "garage_advances", "customer_advances")]
    return known.select(
        *keep,
        "claim.*",
        F.explode("objects").alias("object"),
        F.coalesce(newest, F.lit("0")).alias("compensation_amount_lcy"),
        F.when(car, F.col("guaranteed")).alias("guarantee_date"),
        *[F.col(f"price.{c}").alias(c) for c in price],
        F.coalesce("price.deductible_quantity", F.lit(0)).alias("number_of_deduction"),
        garage[0].alias("garage_advance_amt"), garage[1].alias("garage_advance_date"),
        customer[0].alias("customer_advance_amt"), customer[1].alias("customer_advance_date"),
    ).select("*", F.col("object.certificate_id").alias("certificate_id"), F.col("object.codes").alias("business_type_code")).drop("object")


def claim_snapshot(
    sources: Mapping[str, DataFrame], as_of, claim_ids: tuple | None = None, save: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """One wide row per claim and insured object on a date: the columns of ``RECORD``, their
    fingerprint ``row_hash`` and the day ``fk_date``. Columns that no source has are NULL.

    ``sources`` holds the tables of a claim (claims, clauses, estimates, log, prices, car_claims,
    garage_debt, advances, garage_payments, customer_payments), which are put under each other and
    folded by (unit_code, claim_id) in one aggregation, and the tables that a claim refers to
    (policies, certificates, customers, units, departments, agencies, vip_customers, calls), which are
    joined. ``claim_ids`` cuts all claim tables to a range of ids. Of several approved prices of a
    claim the newest counts; what is taken back is summed. A claim without clauses has no row.

    The clauses, garage advances and customer advances of a claim are lists in its row, as the record
    shows them all; other tables may have any number of rows for a claim. ``save`` writes the fold once, so
    that the files of its shuffles are gone before those of the joins are written."""
    wide = claim_fold(claim_entries(sources, as_of, claim_ids))
    if save is not None:
        wide = save(wide, "claim-fold")
    managed = {name: sources[name].withColumnRenamed("unit_code", "manage_unit_code") for name in ("policies", "certificates", "units", "agencies", "calls")}
    wide = asof_dim_join(wide, managed["policies"], ["manage_unit_code", "policy_id"], as_of)
    wide = asof_dim_join(wide, managed["certificates"], ["manage_unit_code", "policy_id", "certificate_id"], as_of)
    customers = sources["customers"]
    wide = asof_dim_join(wide, customers.withColumnRenamed("custid", "custid_kt"), ["custid_kt", "unit_code"], as_of)
    wide = asof_dim_join(wide, managed["units"], ["manage_unit_code"], as_of)
    wide = asof_dim_join(wide, sources["departments"], ["unit_code", "department_code"], as_of)
    wide = asof_dim_join(wide, managed["agencies"].withColumnRenamed("agency_id", "sale_code"), ["manage_unit_code", "sale_code"], as_of)
    wide = asof_dim_join(wide, sources["vip_customers"], ["unit_code", "custid"], as_of)

    wide = channel_fallback(wide)
    wide = vip_label(wide, "vip_customer_type", "vip_code")
    wide = map_codes(wide, "department_code", REGION_DEPARTMENTS, "", "region")
    wide = map_codes(wide, "claim_detail_status", STATUS_NAMES, "", "claim_detail_status_name")
    calls = managed["calls"].filter(F.col("valid") == 1).select(
        "manage_unit_code", "call_center_id", F.col("created_date").alias("call_date")
    )
    wide = patch_from(wide, calls, ["manage_unit_code", "call_center_id"], ["call_date"], "call_date")
    if "garage_code" in wide.columns:
        # The record shows the parent of the garage; the policy's parent is in the sales channels.
        garages = customers.select(
            "unit_code", F.col("custid").alias("garage_code"), F.col("custid_tong").alias("__parent"), "eff_date", "end_date"
        )
        wide = asof_dim_join(wide, garages, ["unit_code", "garage_code"], as_of)
        wide = wide.withColumn("custid_tong", F.col("__parent"))
    wide = wide.withColumn(
        "certificate_effective_date",
        assemble_timestamp(F.col("certificate_effective_date"), F.col("certificate_effective_time")),
    )
    record = wide.select(*[F.col(c) if c in wide.columns else F.lit(None).cast("string").alias(c) for c in RECORD])
    return with_fingerprint(record, RECORD).withColumn("fk_date", F.lit(as_of).cast("date"))
