"""Parameters of the credit-risk operators.

``CreditConfig`` is read by every operator, so columns, bins, bands and limits
can all be replaced without touching the library.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from math import inf


@dataclass(frozen=True)
class BinSpec:
    """Right-closed classes of one variable: ``(edges[i], edges[i+1]]``."""

    variable: str
    edges: tuple[float, ...]
    direction: str = ""
    labels: tuple[str, ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return self.labels or tuple(f"C{i}" for i in range(1, len(self.edges)))


@dataclass(frozen=True)
class Band:
    """Risk band ``[lower, next band's lower)``; the last one is open-ended."""

    lower: float
    label: str
    color: str
    recommendation: str
    level: int


@dataclass(frozen=True)
class DomainRule:
    """Inclusive range, or list of allowed values, of one input column.

    A table without a ``required`` column has no valid row; ``integer`` refuses
    fractions.
    """

    column: str
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] = ()
    integer: bool = False
    required: bool = True


@dataclass(frozen=True)
class Limit:
    """Acceptance limit of one metric; ``relation`` is ``>=``, ``>`` or ``<``.

    ``reading`` says what a value within the limit means, ``warning`` one beyond it.
    """

    metric: str
    relation: str
    bound: float
    reading: str = ""
    warning: str = "Insuffisant"


# --- Fixed values: results depend on them, so they are kept as published -----

RISING, FALLING = "croissant", "decroissant"

WOE_BINS = (
    BinSpec("bureau_score", (-inf, 500, 600, 680, inf), FALLING),
    BinSpec("max_dpd_12m", (-inf, 0, 15, 45, inf), RISING),
    BinSpec("dti", (-inf, 0.3, 0.5, 0.7, inf), RISING),
    BinSpec("utilization_rate", (-inf, 0.3, 0.5, 0.7, inf), RISING),
    BinSpec("missed_payments_3m", (-inf, 0, 1, 2, inf), RISING),
    BinSpec("overdrawn_days_3m", (-inf, 0, 5, 15, inf), RISING),
    BinSpec("number_of_credit_inquiries_6m", (-inf, 1, 3, 5, inf), RISING),
    BinSpec("monthly_income", (-inf, 1500, 2500, 4000, inf), FALLING),
)

RATE_BUCKETS = (
    BinSpec(
        "bureau_score",
        (300, 450, 550, 620, 680, 730, 780, 850),
        labels=("300-450", "450-550", "550-620", "620-680", "680-730", "730-780", "780-850"),
    ),
    BinSpec(
        "dti",
        (0, 0.2, 0.4, 0.6, 0.8, 1.0, 10),
        labels=("0-20%", "20-40%", "40-60%", "60-80%", "80-100%", ">100%"),
    ),
    BinSpec(
        "max_dpd_12m",
        (-1, 0, 15, 30, 60, 90, 1000),
        labels=("0 jours", "1-15", "16-30", "31-60", "61-90", ">90"),
    ),
    BinSpec(
        "utilization_rate",
        (0, 0.2, 0.4, 0.6, 0.8, 1.0),
        labels=("0-20%", "20-40%", "40-60%", "60-80%", "80-100%"),
    ),
)

EMPLOYMENT_CATEGORIES = ("Permanent", "Self_Employed", "Student", "Temporary", "Unemployed")

EMPLOYMENT_NAMES = {
    "Permanent": "Permanent (CDI)",
    "Self_Employed": "Indépendant",
    "Student": "Étudiant",
    "Temporary": "Temporaire (CDD)",
    "Unemployed": "Sans emploi",
}

FLAG_NAMES = {1: "Oui", 0: "Non"}

TARGET_NAMES = {0: "Non-defaut", 1: "Defaut"}

RISK_BANDS = (
    Band(0.00, "Faible", "#27AE60", "Approuver", 1),
    Band(0.15, "Modere", "#F0A500", "Approuver avec suivi", 2),
    Band(0.35, "Eleve", "#E67E22", "Revue manuelle", 3),
    Band(0.55, "Tres eleve", "#C0392B", "Refuser", 4),
)

# Upper bound (exclusive) of the information value of each power class.
POWER_CLASSES = (
    (0.02, "Tres faible"),
    (0.1, "Faible"),
    (0.3, "Moyen"),
    (0.5, "Fort"),
    (inf, "Tres fort"),
)

ZERO_SHARE_FLOOR = 0.0001

DOMAIN_RULES = (
    DomainRule("bureau_score", 300, 850),
    DomainRule("monthly_income", 0, 50000),
    DomainRule("dti", 0.0, 5.0),
    DomainRule("utilization_rate", 0.0, 2.0),
    DomainRule("num_credit_lines", 0, 50, integer=True),
    DomainRule("missed_payments_3m", 0, 30, integer=True),
    DomainRule("overdrawn_days_3m", 0, 90, integer=True),
    DomainRule("max_dpd_12m", 0, 365, integer=True),
    DomainRule("salary_domiciliation", 0, 1, integer=True),
    DomainRule("employment_status", allowed=EMPLOYMENT_CATEGORIES),
)

METRIC_LIMITS = (
    Limit("auc", ">=", 0.75, "Excellent"),
    Limit("gini", ">=", 0.50, "Excellent"),
    Limit("ks", ">=", 0.30, "Bon"),
    Limit("f1", ">", 0.45, "Bon"),
    Limit("auc_gap", "<", 0.02, "Pas d'overfitting", "Overfitting"),
)

# Rows of the metric summary: shown name and metric, in order.
METRIC_SUMMARY = (
    ("AUC-ROC (Test)", "auc"),
    ("AUC-ROC (Train)", "auc_train"),
    ("Ecart Train / Test", "auc_gap"),
    ("Coefficient Gini", "gini"),
    ("KS Statistic", "ks"),
    ("F1-Score", "f1"),
    ("Precision", "precision"),
    ("Rappel (Sensibilite)", "recall"),
    ("Specificite", "specificity"),
)

# Rows of the model comparison: shown name and metric, in order.
COMPARED_METRICS = (
    ("AUC-ROC", "auc"),
    ("Gini", "gini"),
    ("KS", "ks"),
    ("Rappel", "recall"),
    ("Precision", "precision"),
    ("F1-Score", "f1"),
    ("TP", "tp"),
    ("FP", "fp"),
    ("FN", "fn"),
    ("TN", "tn"),
)

NUMERIC_COLUMNS = (
    "bureau_score",
    "dti",
    "utilization_rate",
    "max_dpd_12m",
    "missed_payments_3m",
    "overdrawn_days_3m",
    "number_of_credit_inquiries_6m",
    "monthly_income",
)

EFFECTS = {"raises": "Risque", "lowers": "Protection"}

# --- End of fixed values -----------------------------------------------------


def with_optional(rules: tuple[DomainRule, ...], *columns: str) -> tuple[DomainRule, ...]:
    """The rules, without requiring some of their columns."""
    return tuple(replace(r, required=r.required and r.column not in columns) for r in rules)


@dataclass(frozen=True)
class CreditConfig:
    id_column: str = "customer_id"
    target: str = "default_12m"
    numeric_columns: tuple[str, ...] = NUMERIC_COLUMNS
    binary_columns: tuple[str, ...] = ("salary_domiciliation",)
    category_column: str = "employment_status"
    categories: tuple[str, ...] = EMPLOYMENT_CATEGORIES

    impute_columns: tuple[str, ...] = ("bureau_score", "monthly_income")
    cap_columns: tuple[str, ...] = ("monthly_income", "dti", "utilization_rate")
    cap_quantile: float = 0.99
    missing_alert_pct: float = 5.0

    test_share: float = 0.2
    seed: int = 42
    folds: int = 5

    c: float = 1.0
    class_weight: str | None = None
    max_iter: int = 1000

    bins: tuple[BinSpec, ...] = WOE_BINS
    rate_buckets: tuple[BinSpec, ...] = RATE_BUCKETS
    max_categories: int = 1000
    small_bucket_rows: int = 1_000_000
    bands: tuple[Band, ...] = RISK_BANDS
    rules: tuple[DomainRule, ...] = DOMAIN_RULES
    limits: tuple[Limit, ...] = METRIC_LIMITS
    power_classes: tuple[tuple[float, str], ...] = POWER_CLASSES
    minimum_iv: float = 0.02
    category_names: dict[str, str] = field(default_factory=lambda: dict(EMPLOYMENT_NAMES))
    flag_names: dict[int, str] = field(default_factory=lambda: dict(FLAG_NAMES))
    target_names: dict[int, str] = field(default_factory=lambda: dict(TARGET_NAMES))

    @property
    def dummy_columns(self) -> tuple[str, ...]:
        """0/1 columns of the category; the first category is the reference."""
        return tuple(f"{self.category_column}_{v}" for v in self.categories[1:])

    @property
    def woe_features(self) -> tuple[str, ...]:
        return tuple(b.variable for b in self.bins) + self.binary_columns + self.dummy_columns

    @property
    def woe_pattern_bound(self) -> int:
        """Most distinct feature rows a WOE model can see, whatever the table size."""
        bound = 2 ** len(self.binary_columns) * (len(self.dummy_columns) + 1)
        for spec in self.bins:
            bound *= len(spec.names)
        return bound
