"""The wide pipeline: seven tables to one matrix, in two published variants.

``SELECTED`` adds ratios between subsets and drops a caller-given list of columns;
``SIMPLE`` is the older variant. They differ in prefixes, specs and applicant
features, which a :class:`Variant` holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import (
    col,
    contact_flags,
    document_flags,
    drop_listed,
    string_columns,
)
from sparkfeat.functions.scalars import RowStat, product, ratio, with_row_stats
from sparkfeat.operators.aggregate import Spec, aggregate, all_numeric_spec, subset_ratios
from sparkfeat.operators.assemble import assemble
from sparkfeat.operators.categories import MAX_VALUES, Vocabulary, first_seen_codes, one_hot, share_spec, with_codes
from sparkfeat.operators.impute import fill_global_mean
from sparkfeat.operators.rollup import attach_child_stats
from sparkfeat.plans import specs
from sparkfeat.plans.library import (
    clean_employment,
    clean_previous,
    gen_prev_installment_feature,
    gen_reduced_relative_calculation,
    income_by_organisation,
    ratios,
    with_payment_columns,
)
from sparkfeat.sources.schemas import BUREAU_KEY, ENTITY_KEY, LOAN_KEY

Vocabularies = Mapping[str, Vocabulary]


@dataclass(frozen=True)
class Variant:
    """Names and specs of one variant of the wide pipeline."""

    bureau_spec: Spec
    previous_spec: Spec
    installments_spec: Spec
    installments_prefix: str
    active: str
    closed: str
    approved: str
    refused: str
    ratios: bool
    full_application: bool
    drop: tuple[str, ...] = field(default=())

    def dropping(self, names: Iterable[str]) -> Variant:
        """The variant with a list of columns to leave out of every frame."""
        return Variant(**{**self.__dict__, "drop": tuple(names)})


# Prefixes of the two variants.
SELECTED = Variant(
    bureau_spec=specs.SELECTED_BUREAU_SPEC,
    previous_spec=specs.SELECTED_PREVIOUS_SPEC,
    installments_spec=specs.SELECTED_INSTALLMENTS_SPEC,
    installments_prefix="INSTAL_",
    active="ACTIVE_",
    closed="CLOSED_",
    approved="APPROVED_",
    refused="REFUSED_",
    ratios=True,
    full_application=True,
)
SIMPLE = Variant(
    bureau_spec=specs.BUREAU_SPEC,
    previous_spec=specs.SELECTED_PREVIOUS_SPEC,
    installments_spec=specs.SELECTED_INSTALLMENTS_SPEC,
    installments_prefix="INS_",
    active="ACT_",
    closed="CLS_",
    approved="APR_",
    refused="REF_",
    ratios=False,
    full_application=False,
)


def fit_vocabularies(tables: Mapping[str, DataFrame], max_values: int = MAX_VALUES) -> dict[str, Vocabulary]:
    """Category values of every table: fit once, reuse when scoring other applicants."""
    return {name: Vocabulary.fit(df, max_values=max_values) for name, df in tables.items()}


def _binary_codes(df: DataFrame) -> DataFrame:
    codes = first_seen_codes(df, specs.BINARY_COLUMNS, ENTITY_KEY)
    return with_codes(df, codes, specs.BINARY_COLUMNS, unknown=-1)


def application_train_test(
    application: DataFrame, variant: Variant = SELECTED, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """One row per applicant: cleaned columns, new features, coded binaries, one-hot categories."""
    df = application
    if variant.full_application:
        df = df.filter(~col("CODE_GENDER").eqNullSafe("XNA"))
    df = clean_employment(df)
    if variant.full_application:
        df = _new_application_features(df)
    else:
        df = df.withColumns(ratios({n: specs.RELATIVE_RATIOS[n] for n in specs.SIMPLE_RATIOS}))
    df = _binary_codes(df)
    names = string_columns(df)
    known = vocabulary.only(names) if vocabulary else Vocabulary.fit(df, names)
    return drop_listed(one_hot(df, known, missing=not variant.full_application), variant.drop)


def _new_application_features(df: DataFrame) -> DataFrame:
    docs, live = tuple(document_flags(df)), tuple(contact_flags(df))
    stats = [
        RowStat("NEW_DOC_IND_AVG", "mean", docs),
        RowStat("NEW_DOC_IND_STD", "std", docs),
        RowStat("NEW_DOC_IND_KURT", "kurt", docs),
        RowStat("NEW_LIVE_IND_SUM", "sum", live),
        RowStat("NEW_LIVE_IND_STD", "std", live),
        RowStat("NEW_LIVE_IND_KURT", "kurt", live),
        RowStat("NEW_EXT_SOURCES_MEAN", "mean", specs.SCORES),
        RowStat("NEW_SCORES_STD", "std", specs.SCORES),
    ]
    made = {
        **ratios(specs.APPLICATION_RATIOS),
        "NEW_INC_PER_CHLD": ratio("AMT_INCOME_TOTAL", 1 + F.col("CNT_CHILDREN")),
        "NEW_ANNUITY_TO_INCOME_RATIO": ratio("AMT_ANNUITY", 1 + F.col("AMT_INCOME_TOTAL")),
        "NEW_SOURCES_PROD": product(*specs.SCORES),
    }
    df = income_by_organisation(df, "NEW_INC_BY_ORG")
    return fill_global_mean(with_row_stats(df.withColumns(made), stats), ["NEW_SCORES_STD"])


def bureau_and_balance(
    bureau: DataFrame,
    bureau_balance: DataFrame,
    variant: Variant = SELECTED,
    vocabulary: Vocabulary | None = None,
    balance_vocabulary: Vocabulary | None = None,
) -> DataFrame:
    known = vocabulary or Vocabulary.fit(bureau)
    statuses = balance_vocabulary or Vocabulary.fit(bureau_balance)
    balance_shares = share_spec(statuses)
    child = attach_child_stats(
        bureau,
        bureau_balance,
        BUREAU_KEY,
        {**specs.BALANCE_SPEC, **balance_shares},
        inputs=statuses.indicators(missing=True),
    )
    spec = {
        **variant.bureau_spec,
        **share_spec(known),
        **{f"{name}_MEAN": ["mean"] for name in balance_shares},
    }
    out = aggregate(
        child,
        ENTITY_KEY,
        spec,
        "BURO_",
        inputs=known.indicators(missing=True),
        subsets={
            variant.active: (F.col("CREDIT_ACTIVE") == "Active", variant.bureau_spec),
            variant.closed: (F.col("CREDIT_ACTIVE") == "Closed", variant.bureau_spec),
        },
    )
    if variant.ratios:
        out = out.withColumns(
            subset_ratios(out, variant.bureau_spec, variant.active, variant.closed, "NEW_RATIO_BURO_")
        )
    return drop_listed(out, variant.drop)


def previous_applications(
    previous: DataFrame, variant: Variant = SELECTED, vocabulary: Vocabulary | None = None
) -> DataFrame:
    known = vocabulary or Vocabulary.fit(previous)
    status = F.col("NAME_CONTRACT_STATUS")
    out = aggregate(
        clean_previous(previous),
        ENTITY_KEY,
        {**variant.previous_spec, **share_spec(known)},
        "PREV_",
        inputs=known.indicators(missing=True),
        subsets={
            variant.approved: (status == "Approved", variant.previous_spec),
            variant.refused: (status == "Refused", variant.previous_spec),
        },
    )
    if variant.ratios:
        out = out.withColumns(
            subset_ratios(out, variant.previous_spec, variant.approved, variant.refused, "NEW_RATIO_PREV_")
        )
    return drop_listed(out, variant.drop)


def _with_size(name: str) -> list[Column]:
    return [F.count(F.lit(1)).alias(name)]


def pos_cash(pos: DataFrame, variant: Variant = SELECTED, vocabulary: Vocabulary | None = None) -> DataFrame:
    known = vocabulary or Vocabulary.fit(pos)
    out = aggregate(
        pos,
        ENTITY_KEY,
        {**specs.POS_CASH_SPEC, **share_spec(known)},
        "POS_",
        inputs=known.indicators(missing=True),
        extra=_with_size("POS_COUNT"),
    )
    return drop_listed(out, variant.drop)


def installments_payments(
    installments: DataFrame, variant: Variant = SELECTED, vocabulary: Vocabulary | None = None
) -> DataFrame:
    known = vocabulary or Vocabulary.fit(installments)
    prefix = variant.installments_prefix
    out = aggregate(
        with_payment_columns(installments),
        ENTITY_KEY,
        {**variant.installments_spec, **share_spec(known)},
        prefix,
        inputs=known.indicators(missing=True),
        extra=_with_size(f"{prefix}COUNT"),
    )
    return drop_listed(out, variant.drop)


def credit_card_balance(
    cards: DataFrame, variant: Variant = SELECTED, vocabulary: Vocabulary | None = None
) -> DataFrame:
    """Five statistics of every numeric column and of every category indicator."""
    known = vocabulary or Vocabulary.fit(cards)
    funcs = ["min", "max", "mean", "sum", "var"]
    spec = {**all_numeric_spec(cards, funcs, [ENTITY_KEY, LOAN_KEY]), **share_spec(known, funcs=funcs)}
    out = aggregate(
        cards, ENTITY_KEY, spec, "CC_", inputs=known.indicators(missing=True), extra=_with_size("CC_COUNT")
    )
    return drop_listed(out, variant.drop)


def wide_matrix(
    tables: Mapping[str, DataFrame], variant: Variant = SELECTED, vocabularies: Vocabularies | None = None
) -> DataFrame:
    """Left join all frames of a variant onto the applicants."""
    v = dict(vocabularies or {})
    installments = tables["installments_payments"]
    frames = [
        bureau_and_balance(
            tables["bureau"], tables["bureau_balance"], variant, v.get("bureau"), v.get("bureau_balance")
        ),
        previous_applications(tables["previous_application"], variant, v.get("previous_application")),
        pos_cash(tables["pos_cash_balance"], variant, v.get("pos_cash_balance")),
        installments_payments(installments, variant, v.get("installments_payments")),
        credit_card_balance(tables["credit_card_balance"], variant, v.get("credit_card_balance")),
    ]
    if variant.full_application:
        frames.append(gen_reduced_relative_calculation(tables["application"]))
        frames.append(gen_prev_installment_feature(installments))
    entity = application_train_test(tables["application"], variant, v.get("application"))
    return drop_listed(assemble(entity, frames, ENTITY_KEY), variant.drop)


__all__ = [
    "SELECTED",
    "SIMPLE",
    "Variant",
    "application_train_test",
    "bureau_and_balance",
    "credit_card_balance",
    "fit_vocabularies",
    "installments_payments",
    "pos_cash",
    "previous_applications",
    "wide_matrix",
]
