"""Feature marts: one row per panel key, built from business logs.

Panels have the columns ``client`` and ``rd`` (reporting date), and ``contract`` where a mart works
per contract. Logs have a ``day``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import scalars as S
from panelkit.operators import lookback as L
from panelkit.operators.aggregates import dedupe_then_agg, limits_features, pivot_actions
from panelkit.operators.joins import interval_join, wide_join
from panelkit.operators.windows import best_row, frame, lag_of, lead_label, moving
from panelkit.scale import checkpoint, lookup_join, parts_for

# Codes of the source systems (fixed values).
ACTIONS = {"logins": [95], "transfers_a": [184], "transfers_b": [168], "transfers_c": [172], "transfers_d": [176],
           "top_up": [219], "card_activation": [54], "card_payment": [37], "deposit_open": [113],
           "deposit_close": [117], "orders": [238], "chat": [78], "login_limit": [96]}
TRANSFERS = ["transfers_a", "transfers_b", "transfers_c", "transfers_d"]
CALL_REASONS = {"early_payment": [23], "collection": [49], "complaints": [50], "console": [29, 40, 27],
                "new_products": [41, 44, 26, 30, 36, 19, 38, 1, 11, 21]}
QUERY_REASON, COMPLAINT_REASON = 5, 8
PENDING, REJECTED, ACCEPTED = [4], [9, 8], [7, 3]
EXCESS_PAYMENT = 16
TRANSFER_IN, TRANSFER_OUT = 17, 18
MORTGAGE, CASH_LOANS = 18, [2, 3, 4, 5]
NO_RECENT_REPORT = -666


def limits_mart(accounts: DataFrame, deposits: DataFrame) -> DataFrame:
    """Limit of an account, hits and changes in the last three months, and the deposit client."""
    out = limits_features(accounts, ["contract"], "rd", "current_limit", "limit_reached", 3)
    same = F.coalesce(F.col("initial_limit") == F.col("current_limit"), F.lit(False)).cast("int")
    owners = deposits.groupBy("contract", "rd").agg(F.max("client").alias("client"))
    return out.withColumn("initial_equals_current", same).join(owners, ["contract", "rd"], "left")


def client_mart(panel: DataFrame, clients: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Employee flag of the valid client row, on the black list now, ever on it."""
    out = interval_join(panel, clients, ["client"], "rd", "valid_from", "valid_to", ["is_bank_employee"])
    listed = blacklist.select("client", F.col("month").alias("rd")).distinct().withColumn("_on", F.lit(1))
    out = out.join(listed, ["client", "rd"], "left").withColumn("is_on_blacklist", F.coalesce("_on", F.lit(0)))
    return L.exists_flag(out.drop("_on"), blacklist, ["client"], "rd", "month", None, "was_ever_on_blacklist")


def complaints_mart(panel: DataFrame, complaints: DataFrame) -> DataFrame:
    """Distinct complaint threads of the last three months by reason and result."""
    reason, result = F.col("reason"), F.col("result")
    kinds = {"query_threads": reason == QUERY_REASON, "complaint_threads": reason == COMPLAINT_REASON,
             "other_threads": ~reason.isin(QUERY_REASON, COMPLAINT_REASON), "pending_threads": result.isin(PENDING),
             "rejected_threads": result.isin(REJECTED), "accepted_threads": result.isin(ACCEPTED)}
    return L.lookback_distinct(panel, complaints, ["client"], "rd", "day", L.months_back("rd", 3), "thread", kinds)


def channel_mart(panel: DataFrame, actions: DataFrame, tokens: DataFrame, visits: DataFrame, contracts: DataFrame,
                 codes: dict[str, list] = ACTIONS) -> DataFrame:
    """Use of the bank's channels: logins, transfers, orders, branch visits, tokens, active contract."""
    key = ["client"]
    out = pivot_actions(panel, actions, key, "rd", "day", "action", codes, L.days_back("rd", 31), "n")
    first = F.col("logins_age_first")
    recent = F.col("logins_total_recent") / F.when(first <= 30, first + 1).otherwise(31)
    spread = reduce(F.least, [F.col(f"{t}_age_first") for t in TRANSFERS])
    moved = sum([F.col(f"{t}_total_recent") for t in TRANSFERS[1:]], F.col(f"{TRANSFERS[0]}_total_recent"))
    flags = {"has_opened_deposit": "deposit_open", "has_closed_deposit": "deposit_close",
             "has_paid_card": "card_payment", "has_activated_card": "card_activation",
             "has_reached_login_limit": "login_limit", "has_new_order": "orders"}
    out = out.select(
        *panel.columns,
        F.coalesce(F.when(first.isNotNull(), recent), F.lit(0.0)).alias("logins_per_day"),
        F.coalesce(S.ratio("logins_total_recent", "logins_days_recent"), F.lit(0.0)).alias("logins_per_login_day"),
        F.when(first.isNotNull(), recent - F.col("logins_total") / (first + 1)).alias("login_activity_diff"),
        F.col("logins_age_last").alias("days_since_login"),
        reduce(F.least, [F.col(f"{t}_age_last") for t in TRANSFERS]).alias("days_since_transfer"),
        F.coalesce(moved / F.when(spread <= 30, spread + 1).otherwise(30), F.lit(0.0)).alias("transfers_per_day"),
        F.col("top_up_days_recent").alias("top_up_days"),
        *[(F.col(f"{c}_days_recent") > 0).cast("int").alias(n) for n, c in flags.items()])
    used = {"physical_tokens": L.count(F.col("type") == 1), "java_tokens": L.count(F.col("type") == 2)}
    out = L.lookback_agg(out, tokens, key, "rd", "day", {"": L.days_back("rd", 30)}, used)
    month = {"": L.Span(F.add_months(F.date_add("rd", 1), -1), F.col("rd"))}
    seen = {"visits": L.count(), "cash_visits": L.total("is_cash"), "sales_visits": L.total("is_sales")}
    out = L.lookback_agg(out, visits, key, "rd", "day", month, seen)
    for c in seen:
        out = lag_of(out, c, key, ["rd"], f"{c}_last")
        out = moving(out, c, key, ["rd"], -11, 0, "avg", f"{c}_year_mean")
    active = interval_join(panel.select("client", "rd"), contracts, key, "rd", "start", "end", ["first_login"], "inner")
    active = active.groupBy("client", "rd").agg(F.min("first_login").alias("_first"), F.lit(1).alias("_has"))
    return (out.join(active, ["client", "rd"], "left")
            .withColumn("has_active_contract", F.coalesce("_has", F.lit(0)))
            .withColumn("months_since_first_login", S.months_diff("rd", "_first")).drop("_first", "_has"))


def unique_calls(calls: DataFrame) -> DataFrame:
    """One row per call and day."""
    return calls.groupBy("day", "call_id").agg(
        F.max("client").alias("client"), F.sum("wait").alias("wait"), F.sum("talk").alias("talk"),
        F.max("answered").alias("answered"), F.max("offered").alias("offered"))


def inbound_call_mart(panel: DataFrame, calls: DataFrame, reasons: DataFrame,
                      codes: dict[str, list] = CALL_REASONS) -> DataFrame:
    """Calls by reason group, mean wait and talk time, one and three months back."""
    group = S.case_of("reason", {n: c for n, c in codes.items()}, "other")
    log = unique_calls(calls).join(reasons, "call_id").withColumn("_group", group)
    measures = {n: L.count(F.col("_group") == n) for n in codes}
    measures |= {"wait": L.mean("wait"), "talk": L.mean("talk"), "answered": L.total("answered"),
                 "offered": L.total("offered")}
    spans = {"_3m": L.open_window(S.month_window_start("rd", 3), "rd"),
             "_1m": L.open_window(S.month_window_start("rd", 1), "rd")}
    found = L.window_agg(panel, log, ["client"], "rd", "day", spans, measures)
    whole = {f"{m}{s}": F.col(f"{m}{s}").cast("int") for m in ("wait", "talk") for s in spans}
    return panel.join(found.withColumns(whole), ["client", "rd"], "left")


def _sum_type(df: DataFrame, col: str) -> str:
    """Type that sums of ``col`` keep in a running total; decimals keep their scale."""
    kind = df.schema[col].dataType
    return f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else kind.simpleString()


def excess_payment_mart(history: DataFrame, transactions: DataFrame, kind: int = EXCESS_PAYMENT) -> DataFrame:
    """Extra payments relative to the instalment: at the date, in three and six months, and ever.

    ``history`` has contract, client, rd and instalment. Dates and payment days stand on one line per contract and then
    on one per client, so each is dealt out once by either and no result is joined back.
    """
    panel = history.select("contract", "client", "rd", "instalment").distinct().withColumn("_day", F.col("rd").cast("date"))
    paid = (transactions.where((F.col("kind") == kind) & F.col("contract").isNotNull() & F.col("day").isNotNull())
            .select("client", "contract", "day", "amount").distinct())
    days = (paid.groupBy("contract", "client", F.col("day").cast("date").alias("_day"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount")))
    line = panel.withColumn("_mark", F.lit(1)).unionByName(days.withColumn("_mark", F.lit(0)), allowMissingColumns=True)
    is_panel = F.col("_mark") == 1
    spans = {"_now": L.Span(F.col("rd"), F.col("rd")), "_3m": L.months_back("rd", 3), "_6m": L.months_back("rd", 6)}
    near = W.partitionBy("contract").orderBy(F.unix_date("_day")).rangeBetween(-6 * 31, 0)
    seen = F.collect_list(F.when(~is_panel, F.struct("_day", "_n", "_amount"))).over(near)
    owned = F.max("_mark").over(W.partitionBy("contract"))
    kinds = {"payments": ("_n", "long"), "amount": ("_amount", _sum_type(days, "_amount"))}

    def inside(span: L.Span, name: str) -> Column:
        c, kind = kinds[name]
        zero = F.lit(0).cast(kind)
        rows = F.filter("_seen", lambda x: span.contains(x["_day"]))
        return F.when(is_panel, F.aggregate(rows, zero, lambda acc, x: (acc + F.coalesce(x[c], zero)).cast(kind)))

    line = line.withColumns({"_seen": seen, "_owned": owned})
    found = {f"{name}{suffix}": inside(span, name) for suffix, span in spans.items() for name in kinds}
    # payments of contracts outside the panel do not count for the client
    counts = (F.col("_mark") == 0) & (F.col("_owned") == 1)
    line = line.withColumns(found).withColumns({c: F.when(counts, F.col(c)) for c in ("_n", "_amount")}).where(is_panel | counts)
    upto = W.partitionBy("client").orderBy("_day", "_mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    line = line.drop("_seen", "_owned").withColumns({"_n_ever": F.sum("_n").over(upto), "_amount_ever": F.sum("_amount").over(upto)})
    known = F.col("client").isNotNull() & F.col("rd").isNotNull()
    size = F.abs("instalment")
    return line.where(is_panel).select(
        "contract", "rd", "client", S.ratio("amount_now", size).alias("paid_now"), "payments_3m",
        S.ratio("amount_3m", size).alias("paid_3m"), "payments_6m", S.ratio("amount_6m", size).alias("paid_6m"),
        F.when(known, F.coalesce("_n_ever", F.lit(0))).alias("payments_ever"),
        F.when(known, (F.coalesce("_amount_ever", F.lit(0)) != 0).cast("int")).alias("has_paid_ever"))


#: Reason texts of a rejection by the bank and by the client (fixed values), and the product of the loan mart.
REJECTIONS, LOAN_PRODUCT = ("Bank", "Klient"), 6


def application_status(texts: tuple[str, str] = REJECTIONS) -> Column:
    """Why an application was turned down, from the reason text."""
    reason = F.col("rejection")
    return S.case_when([(reason == texts[0], F.lit("BankRejected")), (reason == texts[1], F.lit("ClientRejected")),
                        (reason == "", F.lit("NotRejected")), (reason.isNotNull(), F.lit("Other"))])


def best_applications(applications: DataFrame, risk: DataFrame, segments: DataFrame, as_of: Column) -> DataFrame:
    """The best application per client and day: accepted, turned down by the client, by the bank, other."""
    status = F.col("status")
    order = S.case_when([(F.col("contract").isNotNull(), F.lit(1)),
                         (status.isNull() | (status == "ClientRejected"), F.lit(2)),
                         (status == "BankRejected", F.lit(3))], F.lit(4))
    rows = applications.withColumn("status", application_status()).withColumn("age", S.age_years("birth", as_of))
    # the rows are structs, which Spark combines by sorting: they are dealt out before, so that no split is sorted whole
    best = best_row(rows.repartition("client", "day"), ["client", "day"], [order, F.col("application")])
    best = checkpoint(best.join(risk, "application", "left"))  # the interval join reads its facts several times
    return interval_join(best, segments, ["client"], "day", "valid_from", "valid_to", ["segment"])


def loan_application_mart(history: DataFrame, applications: DataFrame, risk: DataFrame, segments: DataFrame,
                          savings: DataFrame, as_of: Column, product: int | None = LOAN_PRODUCT) -> DataFrame:
    """Recent applications against the one that opened the contract, and savings over balance.

    Only applications for ``product`` count, by their column ``product``; None takes all. ``history`` has contract, client, rd, start, planned_end and balance; ``savings`` has client,
    month and savings.
    """
    if product is not None:
        applications = applications.where(F.col("product") == product).drop("product")
    best = checkpoint(best_applications(applications, risk, segments, as_of))
    # the history lies by contract and is collapsed there before it is written
    panel = checkpoint(history.groupBy("client", "contract", "rd").agg(
        F.min("start").alias("start"), F.max("balance").alias("balance"),
        F.max(F.months_between("planned_end", "start")).alias("_tenor")))
    per_month = savings.groupBy("client", F.col("month").alias("rd")).agg(F.max("savings").alias("savings"))
    opened = panel.groupBy("contract", "client").agg(F.min("start").alias("start"), F.max("_tenor").alias("tenor_months"))
    near = L.Span(F.add_months("start", -1), F.add_months("start", 1),
                  lambda day: F.abs(F.months_between(day, F.col("start"))) < 1)
    # only contracts that an application opened need their savings
    applied = best.where(F.col("contract").isNotNull()).drop("status", "rejection")
    first = L.lookback_agg(opened.join(applied, ["contract", "client"]), savings, ["client"], "start", "month", {"": near},
                           {"savings_at_start": L.Measure("max", F.col("savings"), 0)})
    dates = panel.groupBy("client", "rd", "start").agg(F.count(F.lit(1)).alias("_n"))
    log = best.select("client", "day", "risk", "income", "marital", "own", "status")
    recent = _recent_applications(dates, log)
    out = panel.join(per_month, ["client", "rd"], "left").join(recent, ["client", "rd"], "left").join(
        first.select("contract", "client", F.col("risk").alias("risk_at_start"), F.col("income").alias("income_at_start"),
                     F.col("marital").alias("marital_at_start"), "age", "education", "income_type", "segment",
                     F.col("day").alias("_applied"), "tenor_months", "savings_at_start"), ["contract", "client"], "left")
    changed = lambda a, b: F.coalesce((F.col(a) != F.col(b)).cast("int"), F.lit(0)).cast("string")
    had = lambda c: (F.coalesce(F.col(c), F.lit(0)) > 0).cast("int").cast("string")
    return out.select(
        "contract", "client", "rd", F.coalesce("applications", F.lit(0)).alias("applications"),
        (F.coalesce("applications", F.lit(0)) > 0).cast("int").alias("has_application"),
        changed("recent_risk", "risk_at_start").alias("has_risk_change"),
        changed("recent_marital", "marital_at_start").alias("has_marital_change"),
        (F.col("recent_income") - F.col("income_at_start")).alias("income_change"),
        had("bank_rejected").alias("had_bank_rejection"), had("client_rejected").alias("had_client_rejection"),
        "age", "education", F.col("income_at_start").alias("income"), "income_type",
        F.col("marital_at_start").alias("marital"), F.col("risk_at_start").alias("risk"), "segment", "tenor_months",
        "savings_at_start", F.months_between("rd", "_applied").alias("months_since_application"),
        S.ratio("savings", "balance").alias("savings_to_balance"))


def _recent_applications(dates: DataFrame, log: DataFrame) -> DataFrame:
    """Applications in three months before ``rd`` and after the start of a contract, per client and date.

    An application counts once per contract of the client it follows, so ``dates`` has the number
    ``_n`` of contracts per (client, rd, start); the log is collapsed to days first.
    """
    measures = {"applications": L.count(), "recent_risk": L.highest("risk"), "recent_income": L.highest("income"),
                "recent_marital": L.highest("marital"), "recent_own": L.highest("own"),
                "bank_rejected": L.count(F.col("status") == "BankRejected"),
                "client_rejected": L.count(F.col("status") == "ClientRejected")}
    days = L.daily(log, ["client"], "day", measures).withColumn("_bucket", S.month_index("_day"))
    windows = (dates.withColumn("_from", F.greatest(F.add_months("rd", -3), F.date_add("start", 1)))
               .where(F.col("_from") <= F.col("rd"))
               .withColumn("_bucket", F.explode(F.sequence(S.month_index("_from"), S.month_index("rd")))))
    hits = windows.join(days, ["client", "_bucket"]).where(F.col("_day").between(F.col("_from"), F.col("rd")))
    counted = ["applications", "bank_rejected", "client_rejected"]
    return hits.groupBy("client", "rd").agg(
        *[F.sum(F.col(c) * F.col("_n")).alias(c) for c in counted],
        *[F.max(c).alias(c) for c in ("recent_risk", "recent_income", "recent_marital", "recent_own")])


def credit_bureau_mart(panel: DataFrame, reports: DataFrame, requests: DataFrame, credits: DataFrame) -> DataFrame:
    """Credits elsewhere from the latest bureau report before the reporting date.

    ``panel`` has client, rd, start and balance. Credits are collapsed per report and end date before
    they meet the panel; only the borrower's own credits (relationship 1) count.
    """
    base = (panel.repartition("client").groupBy("client", "rd")
            .agg(F.min("start").alias("start"), F.sum("balance").alias("balance")))
    log = reports.select("client", F.col("created").alias("day"), "report", "created")
    latest = L.asof_rows(base, log, ["client"], "rd", "day", ["report", "created"], ["report"])
    latest = latest.where(F.col("report").isNotNull())
    asked = (requests.where((F.col("reason") == 1) & F.col("day").isNotNull()).select("report", F.col("day").cast("date").alias("_asked"))
             .repartition("report").groupBy("report", "_asked").agg(F.count(F.lit(1)).alias("_queries")))
    cash, own = F.col("credit_type").isin(CASH_LOANS), F.col("own") == 1
    is_open = F.col("closed").isNull()
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    per_end = (credits.where("relationship = 1").repartition("report")
               .groupBy("report", F.add_months("opened", F.col("months")).alias("_end"))
               .agg(F.count(F.lit(1)).alias("_all"), one(cash).alias("_cash"),
                    one(is_open & ~own & (F.col("credit_type") == MORTGAGE)).alias("_mortgage"),
                    one(is_open & ~own & cash).alias("_f_cash"), one(is_open & ~own).alias("_f"),
                    one(is_open & ~own & (F.col("dpd") < 90)).alias("_f_good"),
                    F.sum(F.when(is_open & ~own, F.col("balance")).otherwise(0)).alias("_f_balance"),
                    one(is_open & cash).alias("_a_cash"), one(is_open).alias("_a"),
                    one(is_open & cash & own).alias("_o_cash"), one(is_open & own).alias("_o"),
                    one((F.months_between("closed", "opened") < F.col("months") - 1) & cash).alias("_early")))
    # a report's requests and credits meet its dates in one join, and a date's rows lie together behind it
    rows = latest.join(per_end.unionByName(asked, allowMissingColumns=True), "report")
    live = F.col("_end") > F.col("rd")
    asked_in = lambda span: F.sum(F.when(span.contains(F.col("_asked")), F.col("_queries")).otherwise(0))
    # a request adds nothing to the sums of credits, not even zero: a sum of unknown balances stays unknown
    active = lambda c: F.sum(F.when(F.col("_all").isNotNull(), F.when(live, F.col(c)).otherwise(0)))
    agg = rows.groupBy("client", "rd", "report", "created", "start", "balance").agg(
        active("_mortgage").alias("foreign_mortgages"), active("_f_cash").alias("foreign_cash_loans"),
        active("_f").alias("foreign_credits"), active("_f_good").alias("foreign_good_credits"),
        active("_f_balance").alias("foreign_balance"), active("_a_cash").alias("_ac"), active("_a").alias("_aa"),
        active("_o_cash").alias("_oc"), active("_o").alias("_oo"), F.sum("_cash").alias("_c"), F.sum("_all").alias("_n"),
        F.sum("_early").alias("early_closures"),
        asked_in(L.month_distance("rd", 0, 3)).alias("queries_3m"), asked_in(L.month_distance("rd", 0, 1)).alias("queries_1m"),
        F.when(F.col("start").isNotNull(), asked_in(L.month_distance("start", -1, 1))).alias("queries_at_application"))
    agg = agg.where(F.col("_n").isNotNull())
    age = F.months_between("rd", "created")
    own_sum = F.col("balance") * F.col("_n")
    return agg.select(
        "client", "rd", age.alias("months_since_report"), "foreign_mortgages", "foreign_cash_loans", "foreign_credits",
        "foreign_good_credits", "foreign_balance", S.ratio("_ac", "_c").alias("active_cash_share"),
        S.ratio("_aa", "_n").alias("active_share"), S.ratio("_oc", "_ac").alias("own_cash_share"),
        S.ratio("_oo", "_aa").alias("own_share"), "early_closures",
        (F.col("foreign_balance") - own_sum).alias("balance_difference"),
        S.ratio("foreign_balance", own_sum).alias("balance_ratio"),
        F.when(age > 3, F.lit(float(NO_RECENT_REPORT))).otherwise(F.col("queries_3m") / (4 - age)).alias("queries_per_month"),
        "queries_3m", "queries_1m", "queries_at_application")


def transfers_by_bank(transactions: DataFrame) -> DataFrame:
    """Unique transfers in and out per contract, day and bank; the name flag holds when name and surname agree."""
    # both steps group rows that lie together, so the records are dealt out once
    chosen = transactions.where(F.col("kind").isin(TRANSFER_IN, TRANSFER_OUT)).repartition("kind", "contract", "day", "bank")
    return dedupe_then_agg(
        chosen, ["kind", "contract", "day", "amount", "account", "bank"],
        {"name": F.max("same_name"), "surname": F.max("same_surname")},
        ["kind", "contract", "day", "bank", (F.col("name") * F.col("surname")).alias("same_person")],
        amount=F.sum("amount"), transfers=F.count(F.lit(1)))


def account_operations(operations: DataFrame) -> DataFrame:
    """Standing orders and recent operations per account and month (one row per contract and rd)."""
    keys, order = ["contract"], ["rd"]
    out = lag_of(operations, "standing_sum", keys, order, "_before", 0)
    recent = frame(keys, order, -2, 0)
    ever = frame(keys, order, None, 0)
    outgoing = F.col("outgoing")
    return out.select(
        "contract", "rd", (F.col("standing_orders") > 0).cast("int").alias("has_standing_order"),
        ((F.col("standing_orders") == 0) & (F.col("_before") > 0)).cast("int").alias("has_cancelled"),
        "operation_sum", "operations",
        F.sum("cash_atm").over(recent).alias("atm_recent"), F.sum("cash_branch").over(recent).alias("branch_recent"),
        F.sum("transfers_in").over(recent).alias("in_recent"),
        F.sum(outgoing).over(ever).alias("_out_sum"), F.count(outgoing).over(ever).alias("_out_n"),
        F.max(outgoing).over(recent).alias("out_max"),
        (F.max("branch_amount").over(recent) > 0).cast("int").alias("had_branch"))


def by_month(left: DataFrame, right: DataFrame, key: str, how: str = "left", month: str = "rd") -> DataFrame:
    """Equi join on (key, month) of two sides that lie by ``key`` alone, without dealing either out again.

    The month is compared as two bounds: an equality would be a join key, and Spark deals both sides out by all of
    them. A key has at most one row per calendar month on the right, so it compares calendar by calendar.
    """
    other = right.select(F.col(key).alias("_key"), F.col(month).alias("_month"), *[c for c in right.columns if c not in (key, month)])
    same = (F.col(key) == F.col("_key")) & (F.col(month) <= F.col("_month")) & (F.col(month) >= F.col("_month"))
    return left.join(other, same, how).drop("_key", "_month")


def main_banks(deposits: DataFrame, transfers: DataFrame, near: L.Span, wide: dict[int, L.Span],
               suffixes: dict[int, str], parts: int) -> DataFrame:
    """Main bank per client and date for each kind of transfer: by amount and by count in the near window, by amount in the wide one.

    The wide windows hold the near one, so all come from one pass: dates and transfers meet once per contract, whose
    calendar bounds both, and a client's banks are dealt out once.
    """
    day = F.col("day")
    inside = reduce(Column.__or__, [(F.col("kind") == k) & span.test(day) for k, span in wide.items()])
    close = near.test(day)
    moved = transfers.where(F.col("bank").isNotNull() & F.col("kind").isin(*wide)).select("contract", "kind", "day", "bank", "amount")
    pairs = (deposits.select("client", "contract", "rd").join(moved, "contract").where(inside)
             .select("client", "rd", "kind", "bank", "amount", close.alias("_close")))
    banks = pairs.repartition(parts, "client").groupBy("client", "rd", "kind", "bank").agg(
        F.sum("amount").alias("_wide"), F.sum(F.when(F.col("_close"), F.col("amount"))).alias("_near"),
        F.count(F.when(F.col("_close"), 1)).alias("_rows"))

    def top(kind: int, size: str) -> Column:
        return F.min_by("bank", F.when((F.col("kind") == kind) & F.col(size).isNotNull(), F.struct(-F.col(size), F.col("bank"))))

    return banks.withColumn("_rows", F.when(F.col("_rows") > 0, F.col("_rows"))).groupBy("client", "rd").agg(
        *[top(k, c).alias(n) for k, suffix in suffixes.items()
          for c, n in (("_near", f"by_amount{suffix}"), ("_rows", f"by_count{suffix}"), ("_wide", f"by_amount{suffix}_wide"))])


def deposit_mart(panel: DataFrame, deposits: DataFrame, transactions: DataFrame, operations: DataFrame) -> DataFrame:
    """Accounts, balances against earlier months, transfers, standing orders, main banks, payment type.

    ``deposits`` has client, contract, rd, start, balance, active and salary, one row per contract
    and rd; transfers are summed per contract and day before they are joined. Accounts, operations and
    transfers are dealt out by contract once, what becomes of them by client once; all joins and windows
    read the rows where they lie.
    """
    transfers = checkpoint(transfers_by_bank(transactions))
    deposits = checkpoint(deposits)
    incoming = transfers.where(F.col("kind") == TRANSFER_IN)
    per_day = incoming.repartition("contract").groupBy("contract", F.col("day").alias("rd")).agg(
        F.sum("amount").alias("in_amount"), F.sum("transfers").alias("in_count"),
        F.sum(F.col("amount") * F.col("same_person")).alias("same_amount"),
        F.sum(F.col("transfers") * F.col("same_person")).alias("same_count"))
    rows = by_month(by_month(deposits, account_operations(operations), "contract"), per_day, "contract")
    parts = parts_for(deposits.count())
    rows = (rows.repartition(parts, "client")
            .withColumn("_out_mean", S.ratio("_out_sum", "_out_n")))
    paid = S.payment_type(F.sum("atm_recent"), F.sum("branch_recent"), F.sum("in_recent"))
    per = rows.groupBy("client", "rd").agg(
        F.max(F.months_between("rd", "start")).alias("account_months"),
        F.sum(F.when(F.col("balance") * F.col("active") > 0, 1).otherwise(0)).alias("accounts_with_balance"),
        F.sum("active").alias("accounts"), F.sum("balance").alias("balance"), F.max("salary").alias("has_salary"),
        F.sum("in_amount").alias("transfer_amount"), F.sum("in_count").alias("transfer_count"),
        F.sum("same_amount").alias("same_name_amount"), F.sum("same_count").alias("same_name_count"),
        F.max("has_standing_order").alias("has_standing_order"), F.max("has_cancelled").alias("has_cancelled_order"),
        F.sum("operation_sum").alias("operation_sum"), F.sum("operations").alias("operations"),
        paid.alias("payment_type"),
        S.ratio(F.sum(F.round("_out_mean", 6).cast("decimal(24,6)")), F.count("_out_mean")).alias("outgoing_mean"),
        F.max("out_max").alias("outgoing_max"), F.max("had_branch").alias("had_branch_operation"))
    past = frame(["client"], ["rd"], -3, -1)
    per = (per.withColumn("_balance_before", S.ratio(F.sum("balance").over(past), F.count("balance").over(past)))
           .withColumn("outgoing_ratio", F.when(F.col("outgoing_mean") == 0, 1.0)
                       .otherwise(S.ratio("outgoing_max", "outgoing_mean"))))
    out = by_month(panel, per, "client")
    step = F.coalesce(F.col("accounts") - F.max("accounts").over(past), F.lit(0))
    out = out.withColumn("has_opened_account", (step > 0).cast("int")).withColumn(
        "has_closed_account", (step < 0).cast("int"))
    out = out.withColumn("balance_diff", F.coalesce(F.col("balance").cast("double"), F.lit(0.0))
                         - F.coalesce("_balance_before", F.lit(0.0)))
    zero = ["accounts_with_balance", "accounts", "balance", "transfer_amount", "transfer_count", "same_name_amount",
            "same_name_count", "has_salary", "has_standing_order", "has_cancelled_order", "operation_sum", "operations",
            "outgoing_mean", "outgoing_max", "outgoing_ratio", "had_branch_operation"]
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}).withColumn(
        "payment_type", F.coalesce("payment_type", F.lit("LackOfTransfer"))).drop("_balance_before")
    near, wide_in, wide_out = (L.month_distance_open("rd", lo, 3) for lo in (1, -6, -5))
    banks = main_banks(deposits, transfers, near, {TRANSFER_IN: wide_in, TRANSFER_OUT: wide_out},
                       {TRANSFER_IN: "_sender", TRANSFER_OUT: "_addressee"}, parts)
    return by_month(out, banks, "client")


def group_mean_impute(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    """NULL becomes the mean of its group."""
    means = df.groupBy(*by).agg(*[F.avg(c).alias(f"_{c}") for c in cols])
    out = lookup_join(df, means, by, "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_{c}").cast("double")) for c in cols}).drop(
        *[f"_{c}" for c in cols])


def capped_text(col: str, cap: int) -> Column:
    """``min(n, cap)`` as text, 0 for NULL."""
    return F.least(F.coalesce(F.col(col), F.lit(0)), F.lit(cap)).cast("int").cast("string")


def request_class(col: str) -> Column:
    """'1' for at least one request a month, '0' for none, '-666' otherwise."""
    return F.when(F.col(col) >= 1, "1").when(F.col(col) == 0, "0").otherwise(str(NO_RECENT_REPORT))


def model_input(label: DataFrame, blocks: dict[str, DataFrame], key: str, tag: str, zero: list[str] = (),
                fills: dict[str, object] | None = None, text: list[str] = (), caps: dict[str, int] | None = None,
                classes: list[str] = (), impute: list[str] = (), by: str | None = None) -> DataFrame:
    """All feature blocks by the sample key, with the null rules of the scorecard input.

    ``zero`` columns fill with 0, ``fills`` with a constant, ``impute`` with the mean of ``by``;
    ``text`` columns become text, ``caps`` adds capped text and ``classes`` request classes.
    """
    base = label.where(F.col("tag") == tag)
    out = wide_join(base, list(blocks.values()), [key])
    if impute:  # the means and the rows they fill are read from one written table, so the blocks are joined once
        out = group_mean_impute(checkpoint(out), list(impute), [by])
    out = out.fillna({c: 0 for c in zero} | (fills or {}))
    out = out.withColumns({f"{c}_text": capped_text(c, n) for c, n in (caps or {}).items()}
                          | {f"{c}_class": request_class(c) for c in classes})
    return out.withColumns({c: F.col(c).cast("string") for c in text}) if text else out


def attach_score(rows: DataFrame, scores: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their score, and the row counts of input, scores and result for comparison.

    A key that is scored more than once keeps the smallest row in the order of the columns, so reruns agree.
    """
    rest = [c for c in scores.columns if c not in keys]
    unique = scores.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")
    out = rows.join(unique, keys, "left")
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    counts = rows.sparkSession.range(1).select(n(rows).alias("input"), n(scores).alias("scores"), n(out).alias("output"))
    return out, counts


# Churn base and label ---------------------------------------------------------------------------

#: Status of a contract that ended with a big payment (fixed value); 6 is closed early, also the cash loan product.
BIG_PAYMENT_STATUS, CLOSED_STATUS, CASH_LOAN = 666, 6, 6


def big_payment() -> Column:
    """A big repayment before the planned end: the balance falls to a tenth; ``_before`` is the balance of the row before."""
    return F.coalesce((S.ratio("balance", "_before") <= 0.1) & (F.col("balance") < 0)
                      & (F.col("rd") < F.col("planned_end")), F.lit(False))


def true_end_date(history: DataFrame) -> DataFrame:
    """First big repayment before the planned end, else the last reporting date, per contract."""
    marked = lag_of(history, "balance", ["contract"], ["rd"], "_before")
    big = big_payment()
    return marked.groupBy("contract").agg(
        F.coalesce(F.min(F.when(big, F.col("rd"))), F.max("rd")).alias("true_end"),
        F.max(big.cast("int")).alias("had_big_payment"))


def churn_base(history: DataFrame, blacklist: DataFrame, product: int = CASH_LOAN) -> DataFrame:
    """Early-closure flag now and ahead, exclusions, bands and availability per contract and date.

    ``history`` has contract, client, product, rd, start, end, planned_end, balance, dpd, status and
    refinancing, one row per contract and date. All client-wide facts are counts of collapsed days,
    so contracts of one client are never paired.
    """
    # the true end comes from windows over a contract's own rows, so the history is dealt out and written once
    marked = lag_of(history, "balance", ["contract"], ["rd"], "_before")
    whole = W.partitionBy("contract")
    # rows overdue up to a date: peers of the date count, rows without a contract or a date have none
    upto = W.partitionBy("contract").orderBy("rd").rangeBetween(W.unboundedPreceding, W.currentRow)
    overdue = F.sum(F.when(F.col("rd").isNotNull() & (F.col("dpd") > 30), 1).otherwise(0)).over(upto)
    # rows of the product one to three months back, of the same contract and client: no more than the days of such a window
    before = L.month_distance("rd", 1, 3)
    near = W.partitionBy("contract").orderBy(F.unix_date("rd")).rangeBetween(-124, 0)
    seen = F.collect_list(F.when(F.col("product") == product, F.struct("client", "rd"))).over(near)
    mine = F.filter("_seen", lambda x: (x["client"] == F.col("client")) & before.test(x["rd"]))
    marked = marked.withColumns({"_big": F.when(big_payment(), F.col("rd")), "_seen": seen,
                                 "_late": F.when(F.col("contract").isNotNull(), overdue).otherwise(0)})
    marked = marked.withColumn("_own", F.when(F.col("contract").isNotNull(), F.size(mine)).otherwise(0)).drop("_seen")
    marked = marked.withColumns({"true_end": F.coalesce(F.min("_big").over(whole), F.max("rd").over(whole)),
                                 "had_big_payment": F.max(F.col("_big").isNotNull().cast("int")).over(whole)})
    history = checkpoint(marked.drop("_before", "_big"))
    seip = history.where("rd <= true_end").withColumn(
        "status_now", F.when((F.col("rd") == F.col("true_end")) & (F.col("had_big_payment") == 1), BIG_PAYMENT_STATUS)
        .otherwise(F.col("status")))
    # flags hold per client and date, over all contracts the client reports that day: one of them has other rows
    # beside its own if the client has more than the contract with the fewest
    per_client = checkpoint(seip.groupBy("client", "rd").agg(
        (F.sum("_late") == 0).cast("int").alias("dpd_clean"), F.min("_own").alias("_own")))
    own_product = history.where(F.col("product") == product).withColumn("_day", F.col("rd"))
    flags = L.lookback_agg(per_client, own_product, ["client"], "rd", "_day", {"": before}, {"_all": L.count()})
    flags = flags.withColumn("has_other", (F.col("_all") > F.col("_own")).cast("int")).drop("_all", "_own")
    started = history.groupBy("client", "contract", "start").agg(F.lit(1).alias("_one"))
    flags = L.exists_flag(flags, started, ["client"], "rd", "start", L.month_distance("rd", 3, 6), "has_new_contract")
    around = {"_last_3m": L.month_distance("rd", 0, 3), "_next_3m": L.month_distance("rd", -3, 0)}
    flags = L.lookback_agg(flags, blacklist, ["client"], "rd", "month", around, {"blacklisted": L.count()})
    flags = flags.withColumns({f"blacklisted{s}": (F.col(f"blacklisted{s}") > 0).cast("int") for s in around})
    last = history.agg(F.max("rd")).scalar()
    base = seip.where(F.col("product") == product).join(flags, ["client", "rd"], "left")
    not_refinanced = F.coalesce(F.col("refinancing"), F.lit("")) == ""
    closed = ((F.col("status_now") == CLOSED_STATUS) & not_refinanced) | (F.col("status_now") == BIG_PAYMENT_STATUS)
    base = base.withColumns({
        "churn": (closed & (F.col("has_other") == 0)).cast("int"),
        "churn_old": ((F.col("status") == CLOSED_STATUS) & not_refinanced).cast("int")})
    base = lead_label(base, "churn", ["contract"], ["rd"], [1, 2, 3, 4])
    base = lead_label(base, "churn_old", ["contract"], ["rd"], [1, 2, 3, 6])
    tenor = F.months_between("planned_end", "start")
    return base.select(
        "contract", "client", "rd", "start", "end", "planned_end", "balance", "dpd",
        S.band(F.months_between("rd", "start"), 3).alias("mob"), S.tenor_band(tenor).alias("tenor"),
        F.year("start").alias("start_year"), S.period_label("start").alias("start_time"),
        S.period_label("planned_end").alias("planned_end_time"),
        (F.months_between(last, "rd") >= 6).cast("int").alias("has_next_6m"),
        "churn", "churn_in_1", "churn_in_2", "churn_in_3", "churn_in_4", "churn_old", "churn_old_in_1",
        "churn_old_in_2", "churn_old_in_3", "churn_old_in_6", "has_new_contract", "dpd_clean",
        "blacklisted_last_3m", "blacklisted_next_3m")


def eligibility_sample(base: DataFrame, sales: DataFrame, first_year: int = 2012, first_rd: str = "2011-06-30",
                       min_balance: float = 30) -> DataFrame:
    """Rows of the churn base that may be learned from; ``sales`` has contract and day of sale."""
    sold = sales.groupBy("contract").agg(F.min(F.date_add("day", 1)).alias("_sold"))
    days_left = F.datediff("planned_end", "rd")
    label = F.coalesce("churn_in_3", "churn_in_2", "churn_in_1")
    return (base.join(sold, "contract", "left").withColumn("target", label)
            .withColumn("was_sold", F.coalesce(F.col("_sold") <= F.col("rd"), F.lit(False)).cast("int")).drop("_sold")
            .where((F.col("start_year") >= first_year) & (F.col("dpd_clean") == 1) & (F.col("was_sold") == 0)
                   & (F.abs("balance") > min_balance) & (F.months_between("end", "rd") >= 0)
                   & F.when(F.col("tenor") > 24, days_left >= 90).otherwise(days_left >= 60)
                   & ((F.col("target") == 1) | (F.col("churn_in_3") == 0))
                   & (F.col("rd") >= F.lit(first_rd).cast("date")) & (F.col("has_next_6m") == 1)
                   & (F.col("blacklisted_last_3m") == 0)))


def dependent_variable(base: DataFrame, sales: DataFrame, key_map: DataFrame, dates: list[str], tag: str,
                       created: Column | None = None, **rules) -> DataFrame:
    """Label per sample key at the chosen month ends."""
    chosen = eligibility_sample(base, sales, **rules).where(F.col("rd").isin([F.lit(d).cast("date") for d in dates]))
    return (chosen.join(key_map, ["contract", "client", "rd"], "left")
            .select(F.lit(tag).alias("tag"), (F.current_date() if created is None else created).alias("created"),
                    "sample_id", "target"))
