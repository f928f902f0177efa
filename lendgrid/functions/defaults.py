"""Labels, wording, thresholds and column lists of the analytics.

They are data, kept in one place so that every operator takes them as defaults.
"""

# decisions and review states
HIGH_RISK = "alto_riesgo"
LOW_RISK = "riesgo_aceptable"
APPROVED = "approved"
NEEDS_REVIEW = "needs_human_review"

# sentinel of DAYS_EMPLOYED
EMPLOYED_SENTINEL = 365243

# columns that are not model inputs
NON_FEATURES = ("SK_ID_CURR", "TARGET", "IS_TRAIN")

# bureau_balance status to days-past-due level
DPD_LEVELS = {"C": 0, "X": 0, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}

# coverage flag to the column that is null without a record
NO_RECORD = {
    "bureau_no_record": "bureau_count",
    "bb_no_record": "bb_credits_with_history",
    "prev_no_record": "prev_count",
    "pos_no_record": "pos_credits_count",
    "cc_no_record": "cc_cards_count",
    "inst_no_record": "inst_delay_mean",
}

# inputs of the segmentation
SEGMENT_INPUTS = (
    "AGE_YEARS", "EMPLOYED_YEARS", "AMT_INCOME_TOTAL", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
    "credit_to_income", "annuity_to_income", "credit_to_goods",
    "bureau_active_count", "bb_months_count_mean", "prev_approval_rate",
    "pos_dpd_rate", "cc_utilization_mean", "inst_late_rate",
    "bureau_no_record", "bb_no_record", "prev_no_record",
    "pos_no_record", "cc_no_record", "inst_no_record",
)
SEGMENT_COUNT = 5
SEED = 42

# boosted-tree settings
TREE_COUNT = 1086
TREE_DEPTH = 5
LEARNING_RATE = 0.03
ROW_SAMPLE = 0.8
COLUMN_SAMPLE = 0.8
MIN_CHILD = 20
LEAF_PENALTY = 1.0

# adverse-action wording
REASON_TEXT = {
    "EXT_SOURCE_1": "Score de riesgo externo (fuente 1) por debajo del promedio.",
    "EXT_SOURCE_2": "Score de riesgo externo (fuente 2) por debajo del promedio.",
    "EXT_SOURCE_3": "Score de riesgo externo (fuente 3) por debajo del promedio.",
    "prev_annuity_mean": "Cuotas promedio de creditos previos elevadas en relacion al perfil.",
    "credit_to_goods": "Relacion entre el monto solicitado y el valor del bien financiado elevada.",
    "prev_credit_mean": "Monto promedio de creditos previos elevado.",
    "DAYS_EMPLOYED": "Antiguedad laboral corta o irregular.",
    "bureau_debt_mean": "Deuda promedio reportada en burós de credito externos elevada.",
    "AMT_ANNUITY": "Cuota mensual solicitada elevada en relacion al perfil.",
    "pos_months_count": "Historial corto de creditos de consumo (point-of-sale) previos.",
    "OWN_CAR_AGE": "Antiguedad del vehiculo declarado atipica para el perfil.",
    "inst_delay_max": "Atrasos maximos detectados en el pago de cuotas de creditos previos.",
    "AMT_GOODS_PRICE": "Valor del bien a financiar elevado en relacion al perfil.",
    "inst_shortfall_mean": "Pagos parciales (por debajo de lo debido) en creditos previos.",
    "prev_days_decision_mean": "Patron de decisiones sobre solicitudes de credito previas.",
    "NAME_EDUCATION_TYPE_Higher education": "Nivel educativo declarado.",
    "DAYS_ID_PUBLISH": "Antiguedad del documento de identidad declarado.",
    "NAME_FAMILY_STATUS_Married": "Estado civil declarado.",
}
REASON_FALLBACK = ("Valor de '", "' desfavorable para el perfil.")
REASON_LIMIT = 4
PROTECTED = ("CODE_GENDER_M", "CODE_GENDER_F", "DAYS_BIRTH")
# also keeps marital status out of the reasons, as policy text asks
PROTECTED_STRICT_PREFIXES = ("CODE_GENDER", "DAYS_BIRTH", "NAME_FAMILY_STATUS")

# memo checks
PROTECTED_WORDS = (
    "genero", "género", "sexo", "edad", "nacionalidad", "etnia", "raza",
    "religion", "religión", "estado civil",
)
ISSUE_EMPTY = "memo vacio"
ISSUE_REASONS = "mas de 4 reason codes"
ISSUE_NO_CITATION = "decision de alto riesgo sin cita de politica"
ISSUE_PROTECTED = "memo menciona atributo protegido: "
NO_REASONS = "(sin reason codes: riesgo aceptable)"
NO_CITATIONS = "(sin citas de politica)"
REVISION_NOTE = "Esta es una revision. Feedback del evaluador anterior:"

# fairness
AGE_BANDS = ((0, 30, "<30"), (30, 45, "30-45"), (45, 60, "45-60"), (60, 100, "60+"))
PARITY_RANGE = 0.1
IMPACT_FLOOR = 0.8

# retrieval
CHUNK_WORDS, CHUNK_OVERLAP = 180, 30
BM25_K1, BM25_B, BM25_EPSILON = 1.5, 0.75, 0.25
FUSION_K, CANDIDATES, TOP_K = 60, 10, 4

# quality targets
JUDGE_FLOOR = 0.90
FAITHFULNESS_FLOOR, RELEVANCY_FLOOR = 0.90, 0.85

# drift
PSI_ALERT = 0.2
PSI_BINS = 10
PSI_DISCRETE_LIMIT = 20
PSI_FLOOR = 1e-4

# what-if analysis: the columns an applicant can act on
ACTIONABLE = ("AMT_ANNUITY", "AMT_GOODS_PRICE", "credit_to_goods")
