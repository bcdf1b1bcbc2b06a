"""The retail part of the driver contract (the corpus operators have tests of their own)."""

from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.oracle import ORACLE


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE
