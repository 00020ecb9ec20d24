"""The small literal inputs and the answers known for them."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from usagemart.schemas import CLAIMS_SCHEMA, CUSTOMER_SCHEMA, MART_SCHEMA, TELEMETRY_SCHEMA

DAY = date(2024, 1, 30)
BEFORE = DAY - timedelta(days=1)
AS_OF = datetime(2024, 1, 31)

CUSTOMERS = [
    (1001, "Иван", "Иванов", "ivan.ivanov@example.com", "TechCorp", "premium", "2023-01-15",
     "active", 15000.50),
    (1002, "Мария", "Петрова", "maria.petrova@example.com", "BusinessSoft", "enterprise",
     "2023-03-20", "active", 25000.75),
    (1003, "Алексей", "Сидоров", "alexey.sidorov@example.com", "StartupInc", "standard",
     "2023-06-10", "active", 8000.25),
    (1004, "Елена", "Козлова", "elena.kozlova@example.com", "CloudSystems", "premium",
     "2023-08-05", "active", 18000.00),
    (1005, "Дмитрий", "Федоров", "dmitry.fedorov@example.com", "DataLabs", "enterprise",
     "2023-11-30", "active", 32000.50),
]

TELEMETRY = [
    (1001, DAY, 45, 120, 85, 2),
    (1001, BEFORE, 38, 95, 70, 1),
    (1002, DAY, 120, 300, 210, 5),
    (1003, DAY, 25, 60, 40, 0),
    (1003, BEFORE, 30, 75, 50, 1),
    (1004, DAY, 90, 200, 150, 3),
    (1005, DAY, 150, 400, 300, 8),
]

GOLDEN_METRICS = [
    (1001, 83, 41.5, 2, 215, 155, 3, 1.94, 145.4),
    (1002, 120, 120.0, 1, 300, 210, 5, 2.38, 201.0),
    (1003, 55, 27.5, 2, 135, 90, 1, 1.11, 88.5),
    (1004, 90, 90.0, 1, 200, 150, 3, 2.0, 142.0),
    (1005, 150, 150.0, 1, 400, 300, 8, 2.67, 275.0),
]

_SEED_DAY, _SEED_TIME = date(2024, 1, 15), datetime(2024, 1, 15, 2)


def mart_row(customer_id, segment="standard", engagement="10", *, first="A", last="B",
             email=None, value="100", minutes="60", avg="30", days=2, views=10, clicks=5,
             conversions=1, rate="20", registered=date(2023, 1, 1), status="active",
             company="C", loaded=_SEED_DAY, created=_SEED_TIME, updated=_SEED_TIME):
    number = lambda x: None if x is None else Decimal(x)
    return (customer_id, first, last, email, company, segment, registered, status, number(value),
            number(minutes), number(avg), days, views, clicks, conversions, number(rate),
            number(engagement), loaded, created, updated)


SEEDS = [
    mart_row(1001, "premium", "72.5", first="Иван", last="Иванов",
             email="ivan.ivanov@example.com", value="15000.50", minutes="1250.75", avg="45.3",
             days=28, views=3500, clicks=2450, conversions=45, rate="1.84",
             registered=date(2023, 1, 15)),
    mart_row(1002, "enterprise", "88.3", first="Мария", last="Петрова",
             email="maria.petrova@example.com", value="25000.75", minutes="3150.25", avg="105.2",
             days=30, views=8900, clicks=6200, conversions=125, rate="2.02",
             registered=date(2023, 3, 20)),
    mart_row(1003, "standard", "42.8", first="Алексей", last="Сидоров",
             email="alexey.sidorov@example.com", value="8000.25", minutes="650.50", avg="32.5",
             days=20, views=1800, clicks=1250, conversions=18, rate="1.44",
             registered=date(2023, 6, 10)),
]


def customers(spark, rows=CUSTOMERS):
    return spark.createDataFrame(rows, CUSTOMER_SCHEMA)


def telemetry(spark, rows=TELEMETRY):
    return spark.createDataFrame(rows, TELEMETRY_SCHEMA)


def mart(spark, rows=SEEDS):
    return spark.createDataFrame(rows, MART_SCHEMA)


def claims(spark, rows):
    return spark.createDataFrame(
        [(email, name, "reports", 0, 300, asked) for email, name, asked in rows], CLAIMS_SCHEMA)


def by_id(df, key="customer_id"):
    return {row[key]: row for row in df.collect()}
