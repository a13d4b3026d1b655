"""Credit-risk analytics as Spark DataFrame operators."""

from scoreloom.config import Band, BinSpec, CreditConfig, DomainRule, Limit

__all__ = ["Band", "BinSpec", "CreditConfig", "DomainRule", "Limit"]
