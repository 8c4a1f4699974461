"""The feature library: 23 builders, each giving one row per applicant.

Every builder can be called alone. :func:`all_features` gives the same features with
all builders of a table fused into one aggregation of that table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import col, contact_flags, document_flags, numeric_columns
from sparkfeat.functions.scalars import (
    RowStat,
    differs_flag,
    not_negative_flag,
    payment_columns,
    product,
    ratio,
    sentinel_to_null,
    with_row_stats,
)
from sparkfeat.operators.aggregate import (
    Family,
    agg_column,
    aggregate,
    all_numeric_spec,
    family_features,
    filled_sum,
    of_style,
    one_family,
    upper_suffix,
)
from sparkfeat.operators.assemble import assemble
from sparkfeat.operators.categories import Vocabulary, category_counts, sorted_with_missing, status_code_stats
from sparkfeat.operators.impute import fill_global_mean, global_means
from sparkfeat.operators.lookup import counted_lookup
from sparkfeat.operators.ranks import group_median
from sparkfeat.operators.rollup import weighted_rollup
from sparkfeat.operators.sequence import gap_mean_max, gap_std
from sparkfeat.plans import specs
from sparkfeat.sources.checkpoints import stored
from sparkfeat.sources.schemas import BUREAU_KEY, ENTITY_KEY, LABEL, LOAN_KEY

Tables = Mapping[str, DataFrame]
STATUS = "NAME_CONTRACT_STATUS"


# --- applicants --------------------------------------------------------------------


def clean_employment(application: DataFrame) -> DataFrame:
    return sentinel_to_null(application, ["DAYS_EMPLOYED"])


def ratios(definitions: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    return {name: ratio(a, b) for name, (a, b) in definitions.items()}


def gen_relative_calculation(application: DataFrame) -> DataFrame:
    made = ratios(specs.RELATIVE_RATIOS)
    return clean_employment(application).select(ENTITY_KEY, *[e.alias(n) for n, e in made.items()])


def gen_reduced_relative_calculation(application: DataFrame) -> DataFrame:
    return gen_relative_calculation(application).select(ENTITY_KEY, *specs.REDUCED_RATIOS)


def income_by_organisation(application: DataFrame, out: str) -> DataFrame:
    """Attach the median income of the applicant's organisation type."""
    medians = group_median(application, ["ORGANIZATION_TYPE"], "AMT_INCOME_TOTAL", out)
    return counted_lookup(application, medians, "ORGANIZATION_TYPE")


def gen_new_relative_feature(application: DataFrame, clean_sentinel: bool = True) -> DataFrame:
    df = clean_employment(application) if clean_sentinel else application
    df = income_by_organisation(df, "INCOME_BY_ORG")
    stats = [
        RowStat("DOC_IND_KURT", "kurt", tuple(document_flags(application))),
        RowStat("LIVE_IND_SUM", "sum", tuple(contact_flags(application))),
        RowStat("EXT_SOURCES_MEAN", "mean", specs.SCORES),
        RowStat("EXT_SOURCES_STD", "std", specs.SCORES),
    ]
    made = {
        **ratios(specs.NEW_RELATIVE_RATIOS),
        "INCOME_PER_CHLD": ratio("AMT_INCOME_TOTAL", 1 + F.col("CNT_CHILDREN")),
        "NEW_ANNUITY_TO_INCOME_RATIO": ratio("AMT_ANNUITY", 1 + F.col("AMT_INCOME_TOTAL")),
        "SOURCES_PRODUCT": product(*specs.SCORES),
    }
    df = with_row_stats(df.withColumns(made), stats)
    names = ["INCOME_BY_ORG", *made, *[s.name for s in stats]]
    return fill_global_mean(df.select(ENTITY_KEY, *names), ["EXT_SOURCES_STD"])


# --- bureau ------------------------------------------------------------------------


def balance_stats(bureau_balance: DataFrame) -> DataFrame:
    """Per credit: months known, and months per status."""
    counts = category_counts("STATUS", specs.BALANCE_STATUSES, "STATUS_")
    return aggregate(bureau_balance, BUREAU_KEY, specs.BALANCE_SPEC, extra=counts)


def with_balance_stats(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    return bureau.join(balance_stats(bureau_balance), BUREAU_KEY, "left")


def month_balance_family() -> Family:
    return Family.of_spec(specs.BUREAU_SPEC, upper_suffix())


def credit_variety_family() -> Family:
    return Family(
        {"n": F.count("DAYS_CREDIT"), "types": F.count_distinct("CREDIT_TYPE")},
        lambda c: {
            "BUREAU_LOAN_COUNT": c("n"),
            "BUREAU_LOAN_TYPES": c("types"),
            "AVERAGE_LOAN_TYPE": ratio(c("n"), c("types")),
        },
    )


def bureau_active_family() -> Family:
    active = differs_flag("CREDIT_ACTIVE", "Closed")
    return Family({"ACTIVE_COUNT": F.sum(active), "ACTIVE_LOANS_PERCENTAGE": F.avg(active)})


def credit_time_family() -> Family:
    running = not_negative_flag("DAYS_CREDIT_ENDDATE")
    return Family({"MEAN_CREDIT_TIME": F.avg(running), "MAX_CREDIT_TIME": F.max(running)})


def loan_count_family() -> Family:
    still_open = F.col("DAYS_CREDIT_ENDDATE") > 0
    loans = F.count(F.when(still_open, F.col(BUREAU_KEY)))
    return Family(
        {
            "MAX_DAYS_CREDIT_ENDDATE": F.max(F.when(still_open, F.col("DAYS_CREDIT_ENDDATE"))),
            "COUNT_SK_ID_BUREAU": F.when(F.count(F.when(still_open, 1)) > 0, loans),
        }
    )


def debt_families(bureau: DataFrame) -> dict[str, Family]:
    """Debt to credit, overdue to debt and mean prolongation, over columns filled with their means."""
    names = ["AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_OVERDUE", "CNT_CREDIT_PROLONG"]
    means = global_means(bureau, names)
    debt, credit, overdue, prolong = (filled_sum(F.col(n), means[n]) for n in names)
    return {
        "cust_debt_to_credit": Family({"DEBT_CREDIT_RATIO": ratio(debt, credit)}),
        "cust_overdue_debt": Family({"OVERDUE_DEBT_RATIO": ratio(overdue, debt)}),
        "avg_prolong": Family({"AVG_CREDITDAYS_PROLONGED": ratio(prolong, F.count(F.lit(1)))}),
    }


def avg_bureau_family(bureau: DataFrame, vocabulary: Vocabulary) -> Family:
    """Means of all numeric columns, of the months per status, and of the category indicators."""
    shares = vocabulary.indicators(missing=False)
    statuses = [f"STATUS_{s}" for s in specs.BALANCE_STATUSES]
    columns = [*numeric_columns(bureau, [ENTITY_KEY, BUREAU_KEY]), *statuses, *shares]
    means = Family.of_spec({c: ["mean"] for c in columns}, of_style, shares)
    return means.adding(BUREAU_COUNT=F.count(BUREAU_KEY))


def gen_bur_month_balance(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    return one_family(with_balance_stats(bureau, bureau_balance), ENTITY_KEY, month_balance_family())


def gen_credit_variety(bureau: DataFrame) -> DataFrame:
    return one_family(bureau, ENTITY_KEY, credit_variety_family())


def gen_bureau_active(bureau: DataFrame) -> DataFrame:
    return one_family(bureau, ENTITY_KEY, bureau_active_family())


def gen_day_credit_group(bureau: DataFrame) -> DataFrame:
    return gap_mean_max(bureau, ENTITY_KEY, "DAYS_CREDIT", "MEAN_DAYS_DIFF", "MAX_DAYS_DIFF")


def gen_bureau_credit_time(bureau: DataFrame) -> DataFrame:
    return one_family(bureau, ENTITY_KEY, credit_time_family())


def gen_loan_count(bureau: DataFrame) -> DataFrame:
    """Only applicants with a running credit have a row."""
    return one_family(bureau, ENTITY_KEY, loan_count_family()).filter("COUNT_SK_ID_BUREAU is not null")


def gen_cust_debt_to_credit(bureau: DataFrame) -> DataFrame:
    return one_family(bureau, ENTITY_KEY, debt_families(bureau)["cust_debt_to_credit"])


def gen_cust_overdue_debt(bureau: DataFrame) -> DataFrame:
    return one_family(bureau, ENTITY_KEY, debt_families(bureau)["cust_overdue_debt"])


def gen_avg_prolong(bureau: DataFrame) -> DataFrame:
    return one_family(bureau, ENTITY_KEY, debt_families(bureau)["avg_prolong"])


def gen_avg_buro(bureau: DataFrame, bureau_balance: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    family = avg_bureau_family(bureau, vocabulary or Vocabulary.fit(bureau))
    return one_family(with_balance_stats(bureau, bureau_balance), ENTITY_KEY, family)


# --- instalment loans: monthly balances ----------------------------------------------


def pos_cash_family() -> Family:
    spec = {c: ["max"] for c in specs.POS_CASH_MEASURES}
    highest = Family.of_spec(spec, of_style)
    means = Family.of_spec({c: ["mean"] for c in specs.POS_CASH_MEASURES}, of_style)
    return Family({**highest.aggregates, **means.aggregates}).adding(COUNT_OF_SK_ID_PREV=F.count(LOAN_KEY))


def status_means_family(df: DataFrame, statuses: Sequence[str]) -> Family:
    """Means of the numeric columns, and of the status statistics each row of a key shares."""
    means = Family.of_spec({c: ["mean"] for c in numeric_columns(df, [ENTITY_KEY, LOAN_KEY])}, of_style)
    stats = {f"MEAN_OF_{n}": e.cast("double") for n, e in status_code_stats(STATUS, statuses).items()}
    return Family({**means.aggregates, **stats})


def fitted_statuses(df: DataFrame) -> list[str]:
    return sorted_with_missing(df, STATUS, Vocabulary.fit(df, [STATUS]))


def gen_pos_cash_features(pos_cash: DataFrame) -> DataFrame:
    return one_family(pos_cash, ENTITY_KEY, pos_cash_family())


def gen_agg_pos_cash(pos_cash: DataFrame) -> DataFrame:
    return aggregate(pos_cash, ENTITY_KEY, specs.POS_CASH_SPEC)


def gen_mean_pos_cash(pos_cash: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    return one_family(pos_cash, ENTITY_KEY, status_means_family(pos_cash, statuses or fitted_statuses(pos_cash)))


# --- credit cards ------------------------------------------------------------------


def card_mean_family(cards: DataFrame) -> Family:
    return Family.of_spec({c: ["mean"] for c in numeric_columns(cards, [ENTITY_KEY, LOAN_KEY])}, of_style)


def card_agg_family(cards: DataFrame) -> Family:
    spec = all_numeric_spec(cards, ["min", "max", "sum", "var"], [ENTITY_KEY, LOAN_KEY])
    return Family.of_spec(spec, upper_suffix()).adding(CC_COUNT=F.count(F.lit(1)))


def gen_avg_credit_card_bal(cards: DataFrame) -> DataFrame:
    return one_family(cards, ENTITY_KEY, card_mean_family(cards))


def gen_agg_credit_card_bal(cards: DataFrame) -> DataFrame:
    return one_family(cards, ENTITY_KEY, card_agg_family(cards))


def gen_credit_card_bal(cards: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    return one_family(cards, ENTITY_KEY, status_means_family(cards, statuses or fitted_statuses(cards)))


# --- previous applications -----------------------------------------------------------


def clean_previous(previous: DataFrame) -> DataFrame:
    cleaned = sentinel_to_null(previous, specs.DAY_SENTINEL_COLUMNS)
    return cleaned.withColumn("APP_CREDIT_PERC", ratio("AMT_APPLICATION", "AMT_CREDIT"))


def avg_previous_family(previous: DataFrame, vocabulary: Vocabulary) -> Family:
    shares = vocabulary.indicators(missing=False)
    columns = [*numeric_columns(previous, [ENTITY_KEY, LOAN_KEY]), *shares]
    means = Family.of_spec({c: ["mean"] for c in columns}, of_style, shares)
    return means.adding(COUNT_OF_SK_ID_PREV=F.count(LOAN_KEY))


def gen_agg_prev(previous: DataFrame) -> DataFrame:
    return aggregate(clean_previous(previous), ENTITY_KEY, specs.PREVIOUS_SPEC)


def gen_avg_prev(previous: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    return one_family(previous, ENTITY_KEY, avg_previous_family(previous, vocabulary or Vocabulary.fit(previous)))


# --- instalment payments ---------------------------------------------------------------


def with_payment_columns(installments: DataFrame) -> DataFrame:
    made = payment_columns("AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT")
    return installments.withColumns(made)


def payments_family(installments: DataFrame) -> Family:
    names = numeric_columns(installments, [ENTITY_KEY, LOAN_KEY])
    parts = [Family.of_spec({c: [f] for c in names}, of_style).aggregates for f in ["mean", "max", "min"]]
    return Family({**parts[0], **parts[1], **parts[2]})


def gen_agg_installments(installments: DataFrame) -> DataFrame:
    return aggregate(with_payment_columns(installments), ENTITY_KEY, specs.INSTALLMENTS_SPEC)


def gen_avg_payments(installments: DataFrame) -> DataFrame:
    return one_family(installments, ENTITY_KEY, payments_family(installments))


def gen_prev_installment_feature(installments: DataFrame) -> DataFrame:
    """Loan-level statistics of the payment sequence, averaged over the applicant's payments."""
    means = (
        installments.filter(col(LOAN_KEY).isNotNull())
        .groupBy(LOAN_KEY)
        .agg(
            F.avg(col("DAYS_INSTALMENT") - col("DAYS_ENTRY_PAYMENT")).alias("MEAN_OF_LATE_INSTALLMENT"),
            F.avg(col("AMT_INSTALMENT") - col("AMT_PAYMENT")).alias("MEAN_OF_INSUFFICIENT_PAYMENT"),
        )
    )
    filled = fill_global_mean(stored(means), ["MEAN_OF_LATE_INSTALLMENT", "MEAN_OF_INSUFFICIENT_PAYMENT"])
    order = gap_std(installments, LOAN_KEY, "NUM_INSTALMENT_NUMBER", "STD_OF_INSTALLMENT_SEQ")
    names = ["STD_OF_INSTALLMENT_SEQ", "MEAN_OF_LATE_INSTALLMENT", "MEAN_OF_INSUFFICIENT_PAYMENT"]
    return weighted_rollup(installments, LOAN_KEY, ENTITY_KEY, filled.join(order, LOAN_KEY, "left"), names)


# --- all together ------------------------------------------------------------------------


def feature_frames(tables: Tables) -> dict[str, DataFrame]:
    """Every builder by family name, each a frame of its own."""
    application, bureau, balance = tables["application"], tables["bureau"], tables["bureau_balance"]
    pos, cards = tables["pos_cash_balance"], tables["credit_card_balance"]
    previous, installments = tables["previous_application"], tables["installments_payments"]
    return {
        "relative_calculation": gen_relative_calculation(application),
        "new_relative_feature": gen_new_relative_feature(application),
        "prev_installment_feature": gen_prev_installment_feature(installments),
        "bur_month_balance": gen_bur_month_balance(bureau, balance),
        "credit_variety": gen_credit_variety(bureau),
        "bureau_active": gen_bureau_active(bureau),
        "day_credit_group": gen_day_credit_group(bureau),
        "bureau_credit_time": gen_bureau_credit_time(bureau),
        "loan_count": gen_loan_count(bureau),
        "cust_debt_to_credit": gen_cust_debt_to_credit(bureau),
        "cust_overdue_debt": gen_cust_overdue_debt(bureau),
        "avg_prolong": gen_avg_prolong(bureau),
        "avg_buro": gen_avg_buro(bureau, balance),
        "pos_cash_features": gen_pos_cash_features(pos),
        "agg_pos_cash": gen_agg_pos_cash(pos),
        "mean_pos_cash": gen_mean_pos_cash(pos),
        "avg_credit_card_bal": gen_avg_credit_card_bal(cards),
        "agg_credit_card_bal": gen_agg_credit_card_bal(cards),
        "credit_card_bal": gen_credit_card_bal(cards),
        "agg_prev": gen_agg_prev(previous),
        "avg_prev": gen_avg_prev(previous),
        "agg_installments": gen_agg_installments(installments),
        "avg_payments": gen_avg_payments(installments),
    }


def all_features(tables: Tables, entity: DataFrame | None = None) -> DataFrame:
    """All families on one row per applicant, columns named ``<family>__<feature>``.

    The same features as :func:`feature_frames`, but each table is scanned and shuffled
    once for all of its plain families instead of once per builder.
    """
    application, bureau = tables["application"], tables["bureau"]
    pos, cards = tables["pos_cash_balance"], tables["credit_card_balance"]
    previous, installments = tables["previous_application"], tables["installments_payments"]

    bureau_families = {
        "bur_month_balance": month_balance_family(),
        "credit_variety": credit_variety_family(),
        "bureau_active": bureau_active_family(),
        "bureau_credit_time": credit_time_family(),
        "loan_count": loan_count_family(),
        **debt_families(bureau),
        "avg_buro": avg_bureau_family(bureau, Vocabulary.fit(bureau)),
    }
    pos_families = {
        "pos_cash_features": pos_cash_family(),
        "agg_pos_cash": Family.of_spec(specs.POS_CASH_SPEC, upper_suffix()),
        "mean_pos_cash": status_means_family(pos, fitted_statuses(pos)),
    }
    card_families = {
        "avg_credit_card_bal": card_mean_family(cards),
        "agg_credit_card_bal": card_agg_family(cards),
        "credit_card_bal": status_means_family(cards, fitted_statuses(cards)),
    }
    previous_families = {
        "agg_prev": Family.of_spec(specs.PREVIOUS_SPEC, upper_suffix()),
        # plain means keep the day sentinel, as the builder alone does
        "avg_prev": avg_previous_family(previous, Vocabulary.fit(previous)),
    }
    asked = previous.withColumn("APP_CREDIT_PERC", ratio("AMT_APPLICATION", "AMT_CREDIT"))
    payments = with_payment_columns(installments)
    payment_families = {
        "agg_installments": Family.of_spec(specs.INSTALLMENTS_SPEC, upper_suffix()),
        "avg_payments": payments_family(installments),
    }

    def named(df: DataFrame, family: str) -> DataFrame:
        return df.select(ENTITY_KEY, *[col(c).alias(f"{family}__{c}") for c in df.columns if c != ENTITY_KEY])

    start = entity if entity is not None else application.select(ENTITY_KEY, LABEL)
    return assemble(
        start,
        [
            named(gen_relative_calculation(application), "relative_calculation"),
            named(gen_new_relative_feature(application), "new_relative_feature"),
            family_features(with_balance_stats(bureau, tables["bureau_balance"]), ENTITY_KEY, bureau_families),
            named(gen_day_credit_group(bureau), "day_credit_group"),
            family_features(pos, ENTITY_KEY, pos_families),
            family_features(cards, ENTITY_KEY, card_families),
            family_features(asked, ENTITY_KEY, previous_families),
            family_features(payments, ENTITY_KEY, payment_families),
            named(gen_prev_installment_feature(installments), "prev_installment_feature"),
        ],
        ENTITY_KEY,
    )
