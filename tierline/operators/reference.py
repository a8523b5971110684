"""Reference data for lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.operators.stage import insert_missing
from tierline.operators.tables import SnapshotTable

# ISO 4217 codes a new currency reference starts with.
CURRENCIES: dict[str, str] = {
    "USD": "US Dollar", "EUR": "Euro", "GBP": "Pound Sterling", "JPY": "Japanese Yen",
    "INR": "Indian Rupee", "AUD": "Australian Dollar", "HKD": "Hong Kong Dollar", "CAD": "Canadian Dollar",
    "CHF": "Swiss Franc", "CNY": "Chinese Yuan Renminbi", "SGD": "Singapore Dollar", "NZD": "New Zealand Dollar",
    "SEK": "Swedish Krona", "NOK": "Norwegian Krone", "DKK": "Danish Krone", "KRW": "South Korean Won",
    "TWD": "New Taiwan Dollar", "THB": "Thai Baht", "MYR": "Malaysian Ringgit", "IDR": "Indonesian Rupiah",
    "PHP": "Philippine Peso", "BRL": "Brazilian Real", "MXN": "Mexican Peso", "ZAR": "South African Rand",
    "AED": "UAE Dirham", "SAR": "Saudi Riyal", "PLN": "Polish Zloty", "CZK": "Czech Koruna",
    "HUF": "Hungarian Forint", "TRY": "Turkish Lira", "ILS": "Israeli New Shekel",
}


def currency_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CURRENCIES.items()), "currency_code string, currency_name string")


def ensure_currencies(table: SnapshotTable, seed: DataFrame | None = None) -> list[str]:
    """Adds missing codes to the reference and returns them; nothing is changed or removed."""
    rows = seed if seed is not None else currency_seed(table.spark)
    added = insert_missing(table.read(), rows, ["currency_code"])
    codes = [r.currency_code for r in added.select("currency_code").orderBy("currency_code").collect()]
    if codes:
        table.append(rows.filter(rows.currency_code.isin(codes)).dropDuplicates(["currency_code"]))
    return codes
