"""Declared schemas of the credit tables, so that no scan infers types.

Payment days are doubles: files write them with a decimal point.
"""

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


_APPLICATION = dict(
    AMT_CREDIT=DoubleType, AMT_INCOME_TOTAL=DoubleType, AMT_ANNUITY=DoubleType, AMT_GOODS_PRICE=DoubleType,
    DAYS_EMPLOYED=LongType, DAYS_BIRTH=LongType, NAME_FAMILY_STATUS=StringType,
)

SCHEMAS = {
    "application_train": _schema(SK_ID_CURR=LongType, TARGET=IntegerType, **_APPLICATION),
    "application_test": _schema(SK_ID_CURR=LongType, **_APPLICATION),
    "bureau": _schema(
        SK_ID_CURR=LongType, SK_ID_BUREAU=LongType, CREDIT_ACTIVE=StringType, AMT_CREDIT_SUM=DoubleType,
        AMT_CREDIT_SUM_DEBT=DoubleType, AMT_CREDIT_SUM_OVERDUE=DoubleType, AMT_ANNUITY=DoubleType,
    ),
    "bureau_balance": _schema(SK_ID_BUREAU=LongType, MONTHS_BALANCE=IntegerType, STATUS=StringType),
    "previous_application": _schema(
        SK_ID_CURR=LongType, SK_ID_PREV=LongType, NAME_CONTRACT_STATUS=StringType, AMT_CREDIT=DoubleType,
        AMT_ANNUITY=DoubleType, DAYS_DECISION=IntegerType,
    ),
    "POS_CASH_balance": _schema(SK_ID_CURR=LongType, SK_ID_PREV=LongType, SK_DPD=IntegerType),
    "credit_card_balance": _schema(
        SK_ID_CURR=LongType, SK_ID_PREV=LongType, AMT_BALANCE=DoubleType, AMT_CREDIT_LIMIT_ACTUAL=DoubleType,
        SK_DPD=IntegerType,
    ),
    "installments_payments": _schema(
        SK_ID_CURR=LongType, DAYS_ENTRY_PAYMENT=DoubleType, DAYS_INSTALMENT=DoubleType,
        AMT_INSTALMENT=DoubleType, AMT_PAYMENT=DoubleType,
    ),
}

LOG_SCHEMA = _schema(
    timestamp=StringType, sk_id_curr=LongType, probability=DoubleType, threshold=DoubleType, decision=StringType
)
CHUNK_SCHEMA = _schema(doc_id=StringType, chunk_id=StringType, title=StringType, text=StringType)
