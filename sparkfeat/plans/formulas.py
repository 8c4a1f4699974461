"""The formula pipeline: child averages, encodings, scaling, then closed-form features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfeat.functions.columns import (
    col,
    integer_columns,
    numeric_columns,
    rename_all,
    sanitise_columns,
    string_columns,
)
from sparkfeat.functions.scalars import null_count
from sparkfeat.operators.aggregate import aggregate
from sparkfeat.operators.categories import Vocabulary, first_seen_codes, with_codes
from sparkfeat.operators.encode import FoldEncoding, frequency_encode, standardise, unseen_shares
from sparkfeat.operators.evaluate import kfold
from sparkfeat.operators.formula import formula_features
from sparkfeat.sources.schemas import BUREAU_KEY, ENTITY_KEY, LABEL, LOAN_KEY
from sparkfeat.sources.tables import split_labelled

# The encoder's folds, seed and smallest category.
FOLDS = 5
SEED = 42
MIN_SAMPLES_LEAF = 100


def plain(name: str, func: str) -> str:
    return name


def averages(
    df: DataFrame,
    key: str,
    count_of: str | None,
    dummies: Mapping[str, str],
    vocabulary: Vocabulary | None = None,
    prefix: str = "",
    count_name: str | None = None,
) -> DataFrame:
    """Mean of every numeric column and category indicator per key.

    ``dummies`` maps a text column to the prefix of its indicators. The column
    ``count_of`` is replaced by the key's count of it, under ``count_name`` if given.
    """
    known = vocabulary or Vocabulary.fit(df, list(dummies))
    inputs = {}
    for c, lead in dummies.items():
        for v in known.values[c]:
            inputs[f"{lead}{v}"] = F.when(col(c) == F.lit(v), 1).otherwise(0)
    skip = [key] if count_of is None or count_name else [key, count_of]
    spec = {c: ["mean"] for c in [*numeric_columns(df, skip), *inputs]}
    extra = []
    if count_of is not None:
        extra = [F.count(col(count_of)).cast("double").alias(count_name or count_of)]
    out = aggregate(df, key, spec, namer=plain, inputs=inputs, extra=extra)
    return rename_all(out, [c if c == key else prefix + c for c in out.columns])


def merge_suffixed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join where a name on both sides becomes ``<name>_x`` and ``<name>_y``."""
    ours = {c.lower() for c in left.columns if c != key}
    theirs = {c.lower() for c in right.columns if c != key}
    shared = ours & theirs

    def marked(df: DataFrame, suffix: str) -> DataFrame:
        return rename_all(df, [c + suffix if c.lower() in shared and c != key else c for c in df.columns])

    return marked(left, "_x").join(marked(right, "_y"), key, "left")


def child_averages(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Per applicant, averages of bureau, previous loans, monthly balances, cards and instalments."""
    months = averages(
        tables["bureau_balance"],
        BUREAU_KEY,
        "MONTHS_BALANCE",
        {"STATUS": "buro_bal_status_"},
        prefix="avg_buro_",
        count_name="buro_count",
    )
    bureau = tables["bureau"]
    known = Vocabulary.fit(bureau, ["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"])
    bureau = averages(
        bureau.join(months, BUREAU_KEY, "left"),
        ENTITY_KEY,
        BUREAU_KEY,
        {"CREDIT_ACTIVE": "ca__", "CREDIT_CURRENCY": "cu__", "CREDIT_TYPE": "ty__"},
        known,
    )
    previous = tables["previous_application"]
    status = "NAME_CONTRACT_STATUS"
    return [
        bureau,
        averages(previous, ENTITY_KEY, LOAN_KEY, {c: f"{c}_" for c in string_columns(previous)}),
        averages(tables["pos_cash_balance"], ENTITY_KEY, LOAN_KEY, {status: ""}),
        averages(
            tables["credit_card_balance"], ENTITY_KEY, LOAN_KEY, {status: "cc_bal_status__"}, prefix="cc_bal_"
        ),
        averages(tables["installments_payments"], ENTITY_KEY, LOAN_KEY, {}, prefix="inst_"),
    ]


@dataclass(frozen=True)
class EncodedMatrix:
    """Scaled matrix of labelled and unlabelled applicants, and its feature names."""

    frame: DataFrame
    features: tuple[str, ...]


def joined_averages(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Applicants with text columns coded by first appearance in train, and all child averages."""
    application = tables["application"]
    train, _ = split_labelled(application, LABEL)
    texts = string_columns(application)
    df = with_codes(application, first_seen_codes(train, texts, ENTITY_KEY), texts, unknown=-1) if texts else application
    for frame in child_averages(tables):
        df = merge_suffixed(df, frame, ENTITY_KEY)
    return sanitise_columns(df)


def encoded_matrix(joined: DataFrame, encode: Sequence[str] | None = None) -> EncodedMatrix:
    """Target and frequency encodings of the whole-number columns, null count, then scaling.

    ``joined`` is read several times; hand in a stored or checkpointed frame. The
    encoded rows are checkpointed too, before their statistics are taken.
    """
    folded = joined.withColumn("__fold", F.when(col(LABEL).isNotNull(), kfold(ENTITY_KEY, FOLDS, SEED)))
    train, test = split_labelled(folded, LABEL)
    columns = list(encode) if encode is not None else integer_columns(joined, [LABEL])
    smoothing = unseen_shares(train, test, columns)
    fitted = FoldEncoding.fit(train, columns, LABEL, "__fold", FOLDS, MIN_SAMPLES_LEAF, smoothing)
    both = fitted.transform(folded, "__fold").drop("__fold")
    both = both.withColumn("nans", null_count([c for c in both.columns if c != LABEL])).checkpoint()
    both = frequency_encode(both, [c for c in columns if c != ENTITY_KEY]).checkpoint()
    features = numeric_columns(both, [ENTITY_KEY, LABEL])
    return EncodedMatrix(standardise(both, features), tuple(features))


def formula_matrix(
    tables: Mapping[str, DataFrame], formulas: Mapping[str, str], encode: Sequence[str] | None = None
) -> DataFrame:
    """The whole pipeline: one column per formula beside the applicant's key and label.

    The joined averages and the encoded rows are checkpointed: several hundred formulas
    would otherwise pull the whole lineage into one plan.
    """
    matrix = encoded_matrix(joined_averages(tables).checkpoint(), encode)
    return formula_features(matrix.frame, formulas, [ENTITY_KEY, LABEL])
