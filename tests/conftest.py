import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans.durable import release  # noqa: E402
from tillroll.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

CUSTOMER_SCHEMA = ("customer_id string, first_name string, last_name string, email string, "
                   "registration_date date, customer_segment string, country string, "
                   "age_group string")
PRODUCT_SCHEMA = ("product_id string, product_name string, category string, subcategory string, "
                  "brand string, price double, cost double")
TXN_SCHEMA = ("transaction_id string, customer_id string, product_id string, quantity int, "
              "unit_price double, discount_amount double, total_amount double, "
              "transaction_date timestamp, status string")


def d(s):
    return dt.date.fromisoformat(s)


def ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app_name="tillroll-tests")
    yield s
    release(s)
    s.stop()


# A garden shop: five customers (k05 never buys), five products, seven purchases, each
# a basket of its own. The goldens are worked out from these in test_fixture_goldens.py.
@pytest.fixture(scope="session")
def customers(spark):
    rows = [
        ("k01", "Ines", "Faria", "ines@shop.test", d("2021-11-03"), "Trade", "Portugal", "45-54"),
        ("k02", "Tomek", "Zych", "tomek@shop.test", d("2022-02-14"), "Home", "Poland", "25-34"),
        ("k03", "Farah", "Nabil", "farah@shop.test", d("2022-05-30"), "Trade", "Egypt", "35-44"),
        ("k04", "Lu", "Tang", "lu@shop.test", d("2022-07-07"), "Home", "Portugal", "55+"),
        ("k05", "Obi", "Were", "obi@shop.test", d("2022-08-19"), "Club", "Kenya", "18-24"),
    ]
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


@pytest.fixture(scope="session")
def products(spark):
    rows = [
        ("g1", "Spade", "Tools", "Digging", "Irongate", 32.0, 20.0),
        ("g2", "Tulip bulbs", "Plants", "Bulbs", "Flora", 6.0, 2.5),
        ("g3", "Watering can", "Tools", "Watering", "Irongate", 18.0, 11.0),
        ("g4", "Apple tree", "Plants", "Trees", "Orchard", 45.0, 30.0),
        ("g5", "Gloves", "Wear", "Hands", "Irongate", 9.0, 4.0),
    ]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


@pytest.fixture(scope="session")
def transactions(spark):
    rows = [
        ("b1", "k01", "g4", 2, 45.0, 5.0, 85.0, ts("2022-09-05 08:20:00"), "Completed"),
        ("b2", "k01", "g2", 10, 6.0, 0.0, 60.0, ts("2022-09-25 17:05:00"), "Completed"),
        ("b3", "k02", "g1", 1, 32.0, 2.0, 30.0, ts("2022-09-12 12:00:00"), "Completed"),
        ("b4", "k03", "g5", 3, 9.0, 0.0, 27.0, ts("2022-10-02 09:30:00"), "Completed"),
        ("b5", "k02", "g3", 1, 18.0, 0.0, 18.0, ts("2022-10-22 19:45:00"), "Completed"),
        ("b6", "k04", "g3", 2, 18.0, 4.0, 32.0, ts("2022-11-08 07:10:00"), "Completed"),
        ("b7", "k01", "g1", 1, 32.0, 0.0, 32.0, ts("2022-11-14 15:55:00"), "Completed"),
    ]
    return spark.createDataFrame(rows, TXN_SCHEMA)


@pytest.fixture(scope="session")
def enriched(transactions, customers, products):
    from tillroll.operators.enrich import enrich
    return enrich(transactions, customers, products)
