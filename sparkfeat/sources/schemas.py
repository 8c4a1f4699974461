"""Declared schemas of the credit tables: the columns the feature builders read."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "string": T.StringType}


def _schema(**groups: str) -> T.StructType:
    """Struct type from ``kind=" name name ..."`` groups, in the order written."""
    return T.StructType(
        [T.StructField(name, _TYPES[kind.split("_")[0]]()) for kind, names in groups.items() for name in names.split()]
    )


ENTITY_KEY = "SK_ID_CURR"
BUREAU_KEY = "SK_ID_BUREAU"
LOAN_KEY = "SK_ID_PREV"
LABEL = "TARGET"

# File names of the credit tables.
CREDIT_FILES = {
    "application_train": "application_train",
    "application_test": "application_test",
    "bureau": "bureau",
    "bureau_balance": "bureau_balance",
    "previous_application": "previous_application",
    "credit_card_balance": "credit_card_balance",
    "pos_cash_balance": "POS_CASH_balance",
    "installments_payments": "installments_payments",
}

# How the names of text columns begin.
TEXT_PREFIXES = ("NAME_", "CODE_", "CHANNEL_", "PRODUCT_", "WEEKDAY_", "ORGANIZATION_", "OCCUPATION_", "FLAG_LAST_APPL_")

_DOCUMENTS = " ".join(f"FLAG_DOCUMENT_{i}" for i in range(2, 22))

# Column names of the credit tables.
CREDIT_SCHEMAS = {
    "application": _schema(
        long_1="SK_ID_CURR",
        int_1="TARGET",
        string_1="NAME_CONTRACT_TYPE CODE_GENDER FLAG_OWN_CAR FLAG_OWN_REALTY",
        int_2="CNT_CHILDREN",
        double_1="AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE",
        string_2="NAME_TYPE_SUITE NAME_INCOME_TYPE NAME_EDUCATION_TYPE NAME_FAMILY_STATUS NAME_HOUSING_TYPE",
        double_2="REGION_POPULATION_RELATIVE",
        int_3="DAYS_BIRTH DAYS_EMPLOYED DAYS_REGISTRATION DAYS_ID_PUBLISH",
        double_3="OWN_CAR_AGE",
        int_4="FLAG_MOBIL FLAG_EMP_PHONE FLAG_WORK_PHONE FLAG_CONT_MOBILE FLAG_PHONE FLAG_EMAIL",
        string_3="OCCUPATION_TYPE",
        double_4="CNT_FAM_MEMBERS",
        int_5="REGION_RATING_CLIENT_W_CITY",
        string_4="WEEKDAY_APPR_PROCESS_START ORGANIZATION_TYPE",
        double_5="EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3",
        string_5="FONDKAPREMONT_MODE HOUSETYPE_MODE WALLSMATERIAL_MODE EMERGENCYSTATE_MODE",
        double_6="DAYS_LAST_PHONE_CHANGE",
        int_6=_DOCUMENTS,
    ),
    "bureau": _schema(
        long_1="SK_ID_CURR SK_ID_BUREAU",
        string_1="CREDIT_ACTIVE CREDIT_CURRENCY",
        int_1="DAYS_CREDIT CREDIT_DAY_OVERDUE",
        double_1="DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT AMT_CREDIT_MAX_OVERDUE",
        int_2="CNT_CREDIT_PROLONG",
        double_2="AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT AMT_CREDIT_SUM_OVERDUE",
        string_2="CREDIT_TYPE",
        int_3="DAYS_CREDIT_UPDATE",
        double_3="AMT_ANNUITY",
    ),
    "bureau_balance": _schema(long_1="SK_ID_BUREAU", int_1="MONTHS_BALANCE", string_1="STATUS"),
    "previous_application": _schema(
        long_1="SK_ID_PREV SK_ID_CURR",
        string_1="NAME_CONTRACT_TYPE",
        double_1="AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_GOODS_PRICE",
        int_1="HOUR_APPR_PROCESS_START",
        double_2="RATE_DOWN_PAYMENT",
        string_2="NAME_CONTRACT_STATUS",
        int_2="DAYS_DECISION",
        string_3="CODE_REJECT_REASON",
        double_3="CNT_PAYMENT",
        string_4="PRODUCT_COMBINATION",
        double_4="DAYS_FIRST_DRAWING DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE DAYS_TERMINATION",
    ),
    "pos_cash_balance": _schema(
        long_1="SK_ID_PREV SK_ID_CURR",
        int_1="MONTHS_BALANCE",
        double_1="CNT_INSTALMENT CNT_INSTALMENT_FUTURE",
        string_1="NAME_CONTRACT_STATUS",
        int_2="SK_DPD SK_DPD_DEF",
    ),
    "credit_card_balance": _schema(
        long_1="SK_ID_PREV SK_ID_CURR",
        int_1="MONTHS_BALANCE",
        double_1="AMT_BALANCE AMT_CREDIT_LIMIT_ACTUAL AMT_DRAWINGS_ATM_CURRENT AMT_DRAWINGS_CURRENT "
        "AMT_DRAWINGS_OTHER_CURRENT AMT_DRAWINGS_POS_CURRENT AMT_INST_MIN_REGULARITY AMT_PAYMENT_CURRENT "
        "AMT_PAYMENT_TOTAL_CURRENT AMT_RECEIVABLE_PRINCIPAL AMT_RECIVABLE AMT_TOTAL_RECEIVABLE "
        "CNT_DRAWINGS_ATM_CURRENT CNT_DRAWINGS_CURRENT CNT_DRAWINGS_POS_CURRENT CNT_INSTALMENT_MATURE_CUM",
        string_1="NAME_CONTRACT_STATUS",
        int_2="SK_DPD SK_DPD_DEF",
    ),
    "installments_payments": _schema(
        long_1="SK_ID_PREV SK_ID_CURR",
        double_1="NUM_INSTALMENT_VERSION",
        int_1="NUM_INSTALMENT_NUMBER",
        double_2="DAYS_INSTALMENT DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT",
    ),
}
