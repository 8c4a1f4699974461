"""Aggregate specs and ratio definitions of the credit features.

Everything in this file is a fixed value: the names decide the output columns.
"""

from __future__ import annotations

DAY_SENTINEL_COLUMNS = [
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
]

BINARY_COLUMNS = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]

SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")

# name: (numerator, denominator)
RELATIVE_RATIOS = {
    "DAYS_EMPLOYED_PERC": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "INCOME_CREDIT_PERC": ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "ANNUITY_INCOME_PERC": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "LOAN_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_LENGTH": ("AMT_CREDIT", "AMT_ANNUITY"),
    "WORKING_LIFE_RATIO": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "INCOME_PER_FAM": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "CHILDREN_RATIO": ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    "PAYMENT_RATE": ("AMT_ANNUITY", "AMT_CREDIT"),
}
REDUCED_RATIOS = ["INCOME_CREDIT_PERC", "INCOME_PER_PERSON", "ANNUITY_LENGTH", "CHILDREN_RATIO"]
SIMPLE_RATIOS = ["DAYS_EMPLOYED_PERC", "INCOME_CREDIT_PERC", "INCOME_PER_PERSON", "ANNUITY_INCOME_PERC"]

NEW_RELATIVE_RATIOS = {
    "CREDIT_TO_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "CAR_TO_BIRTH_RATIO": ("OWN_CAR_AGE", "DAYS_BIRTH"),
    "CAR_TO_EMPLOY_RATIO": ("OWN_CAR_AGE", "DAYS_EMPLOYED"),
    "PHONE_TO_BIRTH_RATIO": ("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "PHONE_TO_EMPLOY_RATIO": ("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
}
APPLICATION_RATIOS = {
    "NEW_CREDIT_TO_ANNUITY_RATIO": ("AMT_CREDIT", "AMT_ANNUITY"),
    "NEW_CREDIT_TO_GOODS_RATIO": ("AMT_CREDIT", "AMT_GOODS_PRICE"),
    "NEW_EMPLOY_TO_BIRTH_RATIO": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "NEW_CAR_TO_BIRTH_RATIO": ("OWN_CAR_AGE", "DAYS_BIRTH"),
    "NEW_CAR_TO_EMPLOY_RATIO": ("OWN_CAR_AGE", "DAYS_EMPLOYED"),
    "NEW_PHONE_TO_BIRTH_RATIO": ("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
    "NEW_PHONE_TO_EMPLOY_RATIO": ("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
    "NEW_CREDIT_TO_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
}

BALANCE_SPEC = {"MONTHS_BALANCE": ["min", "max", "size"]}
BALANCE_STATUSES = ["0", "1", "2", "3", "4", "5", "C", "X"]

BUREAU_SPEC = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "DAYS_CREDIT_UPDATE": ["min", "max", "mean"],
    "AMT_ANNUITY": ["max", "mean"],
    "MONTHS_BALANCE_MIN": ["min"],
    "MONTHS_BALANCE_MAX": ["max"],
    "MONTHS_BALANCE_SIZE": ["mean", "sum"],
}
SELECTED_BUREAU_SPEC = {**BUREAU_SPEC, "DAYS_CREDIT_UPDATE": ["mean"]}

POS_CASH_SPEC = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
POS_CASH_MEASURES = ["MONTHS_BALANCE", "CNT_INSTALMENT", "SK_DPD", "SK_DPD_DEF"]

PREVIOUS_SPEC = {
    "AMT_ANNUITY": ["min", "max"],
    "AMT_APPLICATION": ["min", "max"],
    "AMT_CREDIT": ["min", "max"],
    "APP_CREDIT_PERC": ["min", "max", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max"],
    "AMT_GOODS_PRICE": ["min", "max"],
    "HOUR_APPR_PROCESS_START": ["min", "max"],
    "RATE_DOWN_PAYMENT": ["min", "max"],
    "DAYS_DECISION": ["min", "max"],
    "CNT_PAYMENT": ["sum"],
}
SELECTED_PREVIOUS_SPEC = {
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
}

INSTALLMENTS_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum", "var"],
    "DBD": ["max", "mean", "sum", "var"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum", "var"],
    "AMT_PAYMENT": ["max", "mean", "sum", "var"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum", "var"],
}
SELECTED_INSTALLMENTS_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
}
