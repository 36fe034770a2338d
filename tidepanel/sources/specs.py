"""Declarative dataset contracts."""

from __future__ import annotations

from dataclasses import dataclass


class SpecError(ValueError):
    """A dataset contract is not usable."""


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    api_name: str
    asset_class: str
    fetch_mode: str
    pk_cols: tuple[str, ...]
    partition_cols: tuple[str, ...]
    date_col: str | None
    required_fields: tuple[str, ...] = ()
    optional_fields: tuple[str, ...] = ()
    limit: int = 2000
    supports_offset: bool = True
    supports_trade_cal: bool = False
    exchange_filter: str | None = None
    market_filter: str | None = None
    timezone: str | None = None

    @property
    def required_columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.pk_cols, *self.required_fields]))

    def problems(self) -> list[str]:
        checks = {
            "name is blank": not self.name.strip(),
            "api_name is blank": not self.api_name.strip(),
            "pk_cols is empty": not self.pk_cols,
            "date_col is blank": self.date_col is not None and not self.date_col.strip(),
            "limit is not positive": self.limit <= 0,
            "pk_cols repeats a column": len(set(self.pk_cols)) < len(self.pk_cols),
            "partition_cols repeats a column": len(set(self.partition_cols)) < len(self.partition_cols),
            "a field is both required and optional": not set(self.required_fields).isdisjoint(self.optional_fields),
        }
        return [text for text, bad in checks.items() if bad]

    def validate(self) -> None:
        found = self.problems()
        if found:
            raise SpecError(f"{self.name or '(unnamed)'}: {'; '.join(found)}")


# How each fetch mode is keyed, partitioned and dated unless a dataset says otherwise.
MODES = {
    "trade_date": {"pk_cols": ("ts_code", "trade_date"), "partition_cols": ("trade_date",), "date_col": "trade_date"},
    "ts_code_range": {"pk_cols": ("ts_code", "trade_date"), "partition_cols": ("ts_code", "start_date", "end_date"), "date_col": "trade_date"},
    "snapshot": {"pk_cols": ("ts_code",), "partition_cols": ("snapshot_date",), "date_col": None},
    "period_month": {"pk_cols": ("month",), "partition_cols": ("snapshot_date",), "date_col": "month", "limit": 10000, "supports_offset": False},
    "period_quarter": {"pk_cols": ("quarter",), "partition_cols": ("snapshot_date",), "date_col": "quarter", "limit": 10000, "supports_offset": False},
}

# Dataset, source name, asset class, mode, extra required fields, deviations.
CATALOG = [
    ("cffex_fut_basic", "fut_basic", "futures", "snapshot", "symbol exchange name list_date", {"exchange_filter": "CFFEX"}),
    ("cffex_fut_daily", "fut_daily", "futures", "ts_code_range", "close", {"exchange_filter": "CFFEX"}),
    ("cffex_fut_mapping", "fut_mapping", "futures", "ts_code_range", "mapping_ts_code", {"exchange_filter": "CFFEX"}),
    ("cffex_opt_basic", "opt_basic", "options", "snapshot", "call_put exercise_price maturity_date list_date delist_date", {"exchange_filter": "CFFEX"}),
    ("cffex_opt_daily", "opt_daily", "options", "ts_code_range", "close settle oi", {"exchange_filter": "CFFEX", "limit": 15000}),
    ("daily_info", "daily_info", "index", "trade_date", "ts_name",
     {"pk_cols": ("trade_date", "exchange", "ts_code"), "partition_cols": ("trade_date", "exchange"), "limit": 4000, "supports_trade_cal": True}),
    ("fx_basic", "fx_obasic", "fx", "snapshot", "classify name", {"limit": 5000}),
    ("fx_daily", "fx_daily", "fx", "ts_code_range", "bid_close ask_close", {"timezone": "GMT"}),
    ("index_basic", "index_basic", "index", "snapshot", "name market", {"limit": 5000}),
    ("index_daily", "index_daily", "index", "ts_code_range", "close", {"limit": 8000}),
    ("index_dailybasic", "index_dailybasic", "index", "ts_code_range", "", {"limit": 3000}),
    ("index_global", "index_global", "index", "ts_code_range", "close", {"limit": 4000}),
    ("index_weekly", "index_weekly", "index", "ts_code_range", "close", {"limit": 1000}),
    ("macro_cpi", "cn_cpi", "macro", "period_month", "", {}),
    ("macro_gdp", "cn_gdp", "macro", "period_quarter", "gdp gdp_yoy", {}),
    ("macro_money_supply", "cn_m", "macro", "period_month", "", {}),
    ("macro_pmi", "cn_pmi", "macro", "period_month", "", {}),
    ("macro_ppi", "cn_ppi", "macro", "period_month", "", {}),
    ("macro_social_financing", "cn_sf", "macro", "period_month", "", {}),
    ("sge_basic", "sge_basic", "macro", "snapshot", "ts_name list_date", {"limit": 100, "supports_offset": False}),
    ("sge_daily", "sge_daily", "macro", "trade_date", "close", {}),
    ("stock_daily", "daily", "stock", "trade_date", "close", {"limit": 6000, "supports_trade_cal": True}),
    ("stock_daily_basic", "daily_basic", "stock", "trade_date", "", {"limit": 6000, "supports_trade_cal": True}),
    ("stock_moneyflow", "moneyflow", "stock", "trade_date", "", {"limit": 6000, "supports_trade_cal": True}),
]


def _spec(name: str, api: str, asset: str, mode: str, extra: str, changes: dict) -> DatasetSpec:
    settings = {**MODES[mode], **changes}
    required = (*settings["pk_cols"], *extra.split())
    return DatasetSpec(name=name, api_name=api, asset_class=asset, fetch_mode=mode, required_fields=required, **settings)


SPECS: dict[str, DatasetSpec] = {row[0]: _spec(*row) for row in CATALOG}
