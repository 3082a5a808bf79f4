"""Business constants of the equipment-health domain.

Everything in the block below is a fixed value: results must equal the
reference's, so these labels, thresholds and weights are stated exactly as
the reference defines them, in their natural order, in one place.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference; do not edit)
# ---------------------------------------------------------------------------

# Status vocabulary, most severe first: critical, danger, caution, normal.
STATUS_CRITICAL = "긴급"
STATUS_DANGER = "위험"
STATUS_CAUTION = "주의"
STATUS_NORMAL = "정상"
STATUS_LEVELS = (STATUS_CRITICAL, STATUS_DANGER, STATUS_CAUTION, STATUS_NORMAL)

# Strict ">" thresholds per level: (vibration RMS, temperature C).
VIBRATION_CRITICAL, TEMPERATURE_CRITICAL = 10.0, 90.0
VIBRATION_DANGER, TEMPERATURE_DANGER = 7.0, 75.0
VIBRATION_CAUTION, TEMPERATURE_CAUTION = 4.5, 60.0

# Equipment criticality grades: core, important, auxiliary.
CRIT_CORE = "핵심"
CRIT_IMPORTANT = "중요"
CRIT_AUXILIARY = "보조"
# Priority-score points per grade; any other value scores 5.
CRITICALITY_POINTS = {CRIT_CORE: 30, CRIT_IMPORTANT: 20, CRIT_AUXILIARY: 10}
CRITICALITY_POINTS_OTHER = 5
# Model encoding per grade; missing or other values encode as 0.
CRITICALITY_CODES = {CRIT_CORE: 3, CRIT_IMPORTANT: 2, CRIT_AUXILIARY: 1}
# Dashboard sort rank per grade; other values rank 3.
CRITICALITY_RANK = {CRIT_CORE: 1, CRIT_IMPORTANT: 2}
CRITICALITY_RANK_OTHER = 3

# Remaining-useful-life model: default design life and penalty weights.
RUL_MAX_OPERATING_HOURS = 10000.0
RUL_VIBRATION_WEIGHT = 50
RUL_TEMPERATURE_BASE = 50
RUL_TEMPERATURE_WEIGHT = 30
# Priority score: RUL scale and weight, maintenance-age divisor and cap.
PRIORITY_RUL_SCALE = 10000.0
PRIORITY_RUL_WEIGHT = 40
PRIORITY_DAYS_DIVISOR = 10.0
PRIORITY_DAYS_CAP = 30

# Anomaly type labels: vibration+temperature, high vibration, high temperature.
ANOMALY_BOTH = "진동+온도"
ANOMALY_VIBRATION = "고진동"
ANOMALY_TEMPERATURE = "고온"

# Data-quality rule names and conditions of the silver layer.
RULE_VALID_VIBRATION = ("유효한_진동값", "vibration_rms > 0 AND vibration_rms < 50")
RULE_VALID_TEMPERATURE = ("유효한_온도값", "temperature_c > -20 AND temperature_c < 200")
RULE_VALID_PRESSURE = ("유효한_압력값", "pressure_bar > 0")

# Bronze source tag.
BRONZE_SOURCE = "iot_gateway"

# Maintenance urgency labels: immediately, within this week, next routine check.
URGENCY_IMMEDIATE = "즉시 정비"
URGENCY_THIS_WEEK = "금주 내 정비"
URGENCY_ROUTINE = "다음 정기 정비 시 확인"
URGENCY_CRITICAL_OVER = 5
URGENCY_WARNING_OVER = 10

# Alert message pieces, in order:
# "⚠️ [" status "] " name " (" id ") - " "진동: " v " RMS, " "온도: " t "°C, " "잔여수명: " r "시간"
ALERT_PREFIX = "⚠️ ["
ALERT_VIBRATION = "진동: "
ALERT_VIBRATION_UNIT = " RMS, "
ALERT_TEMPERATURE = "온도: "
ALERT_TEMPERATURE_UNIT = "°C, "
ALERT_RUL = "잔여수명: "
ALERT_RUL_UNIT = "시간"

# OEE quality rule: pressure must exceed this.
OEE_MIN_PRESSURE = 50

# Model hyper-parameters of the remaining-life regressor.
MODEL_TREES = 100
MODEL_MAX_DEPTH = 6
MODEL_LEARNING_RATE = 0.1
MODEL_NUM_LEAVES = 31
MODEL_TEST_FRACTION = 0.2
MODEL_SEED = 42
RUL_LABEL_NOISE = 250.0  # uniform noise in [-250, 250)

# Supervisor routing: agent -> trigger keywords (knowledge search,
# data analysis, prediction).
ROUTING_RULES = {
    "지식_검색_Agent": ["매뉴얼", "절차", "가이드", "방법", "어떻게"],
    "데이터_분석_Agent": ["상태", "데이터", "진동", "온도", "센서", "장비"],
    "예측_Agent": ["수명", "예측", "언제", "RUL", "고장"],
}

# Published descriptions: metric-view columns (view -> dimension or measure -> text), tables, SQL functions.
VIEW_COMMENTS = {
    "mv_equipment_availability": {
        "equipment_id": "장비 ID (EQ-001 ~ EQ-008)",
        "measurement_date": "센서 측정 날짜",
        "total_readings": "총 센서 측정 횟수",
        "normal_readings": "정상 범위 측정 횟수",
        "abnormal_readings": "이상 범위 측정 횟수 (진동 > 7 OR 온도 > 75)",
        "availability_pct": "가동률 (%) - 높을수록 좋음, 90% 이상이 목표",
    },
    "mv_equipment_health": {
        "equipment_id": "장비 ID (EQ-001 ~ EQ-008)",
        "avg_vibration": "평균 진동 RMS - 정상 기준 4.5 이하, 위험 기준 7.0 초과",
        "max_vibration": "최대 진동 RMS",
        "avg_temperature": "평균 온도 (℃) - 정상 기준 60도 이하, 위험 기준 75도 초과",
        "max_temperature": "최대 온도 (℃)",
        "avg_pressure": "평균 압력 (bar)",
        "avg_current": "평균 전류 (A)",
        "total_readings": "총 측정 건수",
        "critical_count": "긴급 상태 건수 (진동>10 OR 온도>90)",
        "warning_count": "위험 이상 건수 (진동>7 OR 온도>75)",
        "anomaly_rate_pct": "이상 징후 비율 (%) - 낮을수록 좋음",
    },
    "mv_oee": {
        "equipment_id": "장비 ID (EQ-001 ~ EQ-008)",
        "availability_pct": "가동률 (%) - 정상 범위 가동 비율",
        "performance_pct": "성능률 (%) - 최적 범위 가동 비율",
        "quality_pct": "품질률 (%) - 유효 데이터 비율",
        "oee_pct": "OEE (%) = 가동률 × 성능률 × 품질률 / 10000",
    },
}
LAYER_COMMENTS = {
    "bronze": "원시 센서 데이터 (Bronze Layer) - IoT 게이트웨이에서 수집된 가공 전 데이터",
    "silver": "정제된 센서 데이터 (Silver Layer) - 품질 검증 및 이상치 태깅 완료",
    "gold": "장비 건강 지표 요약 (Gold Layer) - 장비별 일일 상태 집계",
    "recommendations": "정비 추천 목록 (Gold Layer) - 즉시 정비가 필요한 장비 목록",
}
FUNCTION_COMMENTS = {
    "assess_vibration_status": "진동 RMS와 온도를 기반으로 장비 상태를 판별합니다 (정상/주의/위험/긴급)",
    "estimate_rul": "장비의 잔여 유효 수명(Remaining Useful Life)을 시간 단위로 추정합니다",
    "maintenance_priority_score": "정비 우선순위 점수를 0~100 사이로 계산합니다 (높을수록 긴급)",
}

# ---------------------------------------------------------------------------
# Our own settings (not from the reference)
# ---------------------------------------------------------------------------

# The status rules as a table: (label, vibration limit, temperature limit), most severe first.
STATUS_LIMITS = (
    (STATUS_CRITICAL, VIBRATION_CRITICAL, TEMPERATURE_CRITICAL),
    (STATUS_DANGER, VIBRATION_DANGER, TEMPERATURE_DANGER),
    (STATUS_CAUTION, VIBRATION_CAUTION, TEMPERATURE_CAUTION),
)
# Remaining-life penalty of vibration and temperature: (value that costs nothing, hours per unit above it).
RUL_PENALTIES = ((None, RUL_VIBRATION_WEIGHT), (RUL_TEMPERATURE_BASE, RUL_TEMPERATURE_WEIGHT))

# The reference uses now(); every operator here takes an explicit as_of so
# reruns are reproducible.  Fixture pin: recent readings start 2024-02-01.
DEFAULT_AS_OF = _dt.datetime(2024, 2, 2, 12, 0, 0)
UNROUTED = "unrouted"

# Routing keywords for the driver fixture, whose text is en/fr/de/es prose;
# same three agents as ROUTING_RULES.
FIXTURE_ROUTING_RULES = {
    "지식_검색_Agent": ["with", "avec", "mit", "con"],
    "데이터_분석_Agent": ["the", "les", "der", "las"],
    "예측_Agent": ["this", "pour", "und", "para"],
}

# Quality tag of each stored layer.
LAYER_QUALITY = {"bronze": "bronze", "silver": "silver", "gold": "gold", "recommendations": "gold"}

# BM25 parameters for document retrieval.
BM25_K1 = 1.2
BM25_B = 0.75
RETRIEVE_TOP_K = 5
