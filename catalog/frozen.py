"""Fixed scorecards of our own, so that scores can be checked without a fit."""

from __future__ import annotations

from scoreloom.config import DOMAIN_RULES, RISK_BANDS, CreditConfig, with_optional
from scoreloom.sources.params import Scorecard

# The applicant view has no number of credit lines.
CONFIG = CreditConfig(rules=with_optional(DOMAIN_RULES, "num_credit_lines"))

WOE = {
    "bureau_score": (1.2, 0.1, -0.9, -1.8),
    "max_dpd_12m": (-0.3, 0.1, 0.5, 1.2),
    "dti": (-1.0, -0.4, 0.2, 0.8),
    "utilization_rate": (-1.2, -0.6, 0.1, 0.9),
    "missed_payments_3m": (-0.2, 0.1, 0.4, 1.0),
    "overdrawn_days_3m": (-0.2, 0.0, 0.3, 0.7),
    "number_of_credit_inquiries_6m": (-0.5, -0.1, 0.2, 0.7),
    "monthly_income": (0.6, 0.0, -0.4, -0.8),
}

COEFFICIENTS = {
    **{variable: 0.8 for variable in WOE},
    "salary_domiciliation": -0.3,
    "employment_status_Self_Employed": 0.1,
    "employment_status_Student": 0.2,
    "employment_status_Temporary": 0.4,
    "employment_status_Unemployed": 0.9,
}

INTERCEPT = -1.9

# Coefficients on standardized columns, for the comparison of two models.
STANDARDIZED_COEFFICIENTS = {
    "bureau_score": -0.9,
    "monthly_income": -0.3,
    "dti": 0.5,
    "utilization_rate": 0.8,
    "missed_payments_3m": 0.3,
    "overdrawn_days_3m": 0.2,
    "max_dpd_12m": 0.4,
    "number_of_credit_inquiries_6m": 0.2,
    "salary_domiciliation": -0.2,
    "employment_status_Self_Employed": 0.1,
    "employment_status_Student": 0.1,
    "employment_status_Temporary": 0.3,
    "employment_status_Unemployed": 0.6,
}

STANDARDIZED_INTERCEPT = -2.4


def scorecard(medians: dict[str, float], caps: dict[str, float]) -> Scorecard:
    return Scorecard(
        bins=CONFIG.bins,
        woe={v: {f"C{i}": w for i, w in enumerate(values, start=1)} for v, values in WOE.items()},
        coefficients=COEFFICIENTS,
        intercept=INTERCEPT,
        bands=RISK_BANDS,
        category_column=CONFIG.category_column,
        categories=CONFIG.categories,
        medians=medians,
        caps=caps,
    )
