from tabmine.plans.registry import ORACLE, QUERIES, load_all, query

__all__ = ["ORACLE", "QUERIES", "load_all", "query"]
