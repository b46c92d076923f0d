"""Fixed values of the lending model.

Everything in the block below must equal the values the original pipeline
produces (domains, reason texts, labels), because users filter and join on
them. They are stated once here, in the order the rules apply.
"""

from __future__ import annotations


# --- Fixed values (must stay identical to the source pipeline) -------------

# Accepted domains, compared after trimming and upper-casing.
SEGMENTS = ("MASS MARKET", "PREMIUM", "SME")
LOAN_STATUSES = ("ACTIVE", "CLOSED", "DEFAULT")
INSTALLMENT_STATUSES = ("PAID", "LATE", "DUE", "PARTIAL")
ACCEPTED_PAYMENT_STATUSES = ("CONFIRMED",)
KNOWN_PAYMENT_STATUSES = ("CONFIRMED", "REVERSED", "PENDING")

# Channel used when the source channel is NULL or blank.
UNKNOWN_CHANNEL = "UNKNOWN"

# Reason texts, one per rule, in rule order. A trailing ": " or "(" means the
# raw value is appended.
REASON_NULL_CUSTOMER_ID = "NULL customer_id"
REASON_NULL_FULL_NAME = "NULL full_name"
REASON_NULL_CITY = "NULL city"
REASON_UNKNOWN_SEGMENT = "Segmento no reconocido: "
REASON_BAD_INCOME = "monthly_income inválido"

REASON_NULL_LOAN_ID = "NULL loan_id"
REASON_MISSING_CUSTOMER = "customer_id no existe: "
REASON_BAD_PRINCIPAL = "principal_amount inválido"
REASON_BAD_RATE = "annual_rate inválida"
REASON_BAD_TERM = "term_months inválido"
REASON_UNKNOWN_LOAN_STATUS = "loan_status desconocido: "

REASON_NULL_INSTALLMENT_ID = "NULL installment_id"
REASON_MISSING_LOAN = "loan_id no existe: "
REASON_BAD_PRINCIPAL_DUE = "principal_due inválido"
REASON_BAD_INTEREST_DUE = "interest_due inválido"
REASON_UNKNOWN_INSTALLMENT_STATUS = "Status desconocido: "
REASON_NUMBER_OVER_TERM = ("Nro cuota (", ") supera plazo del crédito (", ")")

REASON_REVERSED = "Pago revertido"
REASON_PENDING = "Pago pendiente de confirmación"
REASON_NON_POSITIVE_AMOUNT = "Monto cero o negativo"
REASON_MISSING_INSTALLMENT = "installment_id no existe: "
REASON_LOAN_MISMATCH = ("loan_id del pago (", ") no coincide con loan de la cuota")

# Ageing buckets of an installment, in evaluation order.
BUCKET_PAID = "PAID"
BUCKET_CURRENT = "VIGENTE"
BUCKET_1_30 = "MORA_1_30"
BUCKET_31_60 = "MORA_31_60"
BUCKET_61_90 = "MORA_61_90"
BUCKET_90_PLUS = "MORA_90_MAS"
BUCKET_OTHER = "OTRO"

# Loan health classes by the worst days overdue, in evaluation order.
HEALTH_UP_TO_DATE = "AL_DIA"
HEALTH_MILD = "ATRASO_LEVE"
HEALTH_MODERATE = "ATRASO_MODERADO"
HEALTH_SEVERE = "DETERIORO_SEVERO"

# Day limits of the buckets and health classes (inclusive upper bounds).
MILD_MAX_DAYS = 30
MODERATE_MAX_DAYS = 90
BUCKET_BOUNDS = ((1, 30, BUCKET_1_30), (31, 60, BUCKET_31_60), (61, 90, BUCKET_61_90))

# Control thresholds from the quality evidence.
MIN_VALID_RATE = 0.85
MAX_REJECTED_RATE = 0.02

# --- End of fixed values ----------------------------------------------------

# White space removed by TRIM: the Unicode White_Space property, so tabs,
# no-break spaces and line separators go too (plain trim() only drops ' ').
WHITESPACE = (
    "\u0020\u0009\u000a\u000b\u000c\u000d\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Money and rate types of the canonical model. Aggregated money widens to
# MONEY_SUM so sums over very large tables cannot overflow.
MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"
RATE = "decimal(9,6)"
