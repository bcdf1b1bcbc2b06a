import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session

    s = build_session("local[*]", 8, app_name="ledgerline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def retail_csv(spark):
    """Fixture sales/customers/products read through the CSV sources."""
    from ledgerline.sources import read_customers_csv, read_products_csv, read_sales_csv

    return {
        "sales": read_sales_csv(spark, f"{FIXTURES}/sales.csv"),
        "customers": read_customers_csv(spark, f"{FIXTURES}/customers.csv"),
        "products": read_products_csv(spark, f"{FIXTURES}/products.csv"),
    }
