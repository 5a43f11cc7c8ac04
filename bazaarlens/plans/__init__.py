from bazaarlens.plans.marketplace import TABLE_NAMES, Marketplace
from bazaarlens.plans.oracle import ORACLE_SQL
from bazaarlens.plans.registry import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "TABLE_NAMES", "Marketplace"]
