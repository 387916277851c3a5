"""Source descriptors, registry and the predefined catalogue."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from goldenrec import settings
from goldenrec.operators import cleaning

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class SourceSpec:
    """How to read, check and transform one source.

    ``read_options`` are merged over the per-format defaults (S2): the
    user's value wins on conflict.
    """

    name: str
    source_path: str
    file_format: str = "csv"
    primary_key_columns: tuple[str, ...] = ()
    dedup_columns: tuple[str, ...] = ()
    quality_rules: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | None = None
    read_options: Mapping[str, str] = field(default_factory=dict)
    transformations: tuple[Transform, ...] = ()

    def __post_init__(self):
        fmt = (self.file_format or "csv").lower()
        object.__setattr__(self, "file_format", fmt)
        object.__setattr__(self, "primary_key_columns", tuple(self.primary_key_columns or ()))
        object.__setattr__(self, "dedup_columns", tuple(self.dedup_columns or ()))
        object.__setattr__(self, "quality_rules", dict(self.quality_rules or {}))
        object.__setattr__(self, "transformations", tuple(self.transformations or ()))
        merged = {**settings.DEFAULT_READ_OPTIONS.get(fmt, {}), **dict(self.read_options or {})}
        object.__setattr__(self, "read_options", merged)

    def expectations(self) -> dict[str, str]:
        """Rules plus one NOT NULL rule per key column (Q4)."""
        from goldenrec.operators.quality import with_key_rules

        return with_key_rules(self.quality_rules, self.primary_key_columns)


class SourceRegistry:
    """S3: name -> spec; a later registration under the same name wins."""

    def __init__(self, specs: Sequence[SourceSpec] = ()):
        self._specs: dict[str, SourceSpec] = {}
        for s in specs:
            self.register(s)

    def register(self, spec: SourceSpec) -> None:
        self._specs[spec.name] = spec

    def names(self) -> list[str]:
        return list(self._specs)

    def get(self, name: str) -> SourceSpec:
        if name not in self._specs:
            raise ValueError(f"no source named {name!r}; registered: {', '.join(self._specs) or 'none'}")
        return self._specs[name]

    def __contains__(self, name: str) -> bool:
        return name in self._specs


# --- predefined catalogue (S12) ----------------------------------------------
# The predefined sources' names, folders, key and dedup columns,
# quality rules and read options below must equal the surveyed catalogue;
# they are stated as written there, source by source, in its order.

EMAIL_FORMAT_RULE = r"email IS NULL OR email RLIKE '^[\\w\\.\\-]+@[\\w\\.\\-]+\\.[a-zA-Z]{2,}$'"


def customers_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="customers", source_path=f"{base}/customers/", file_format="csv",
        primary_key_columns=("customer_id",), dedup_columns=("email", "phone", "first_name", "last_name"),
        quality_rules={
            "valid_customer_id": "customer_id IS NOT NULL",
            "valid_email_format": EMAIL_FORMAT_RULE,
            "valid_name": "first_name IS NOT NULL OR last_name IS NOT NULL",
        },
        read_options={"header": "true", "inferSchema": "true"},
        transformations=(cleaning.normalize_email, cleaning.normalize_phone, cleaning.normalize_names,
                         cleaning.add_full_name),
    )


def products_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="products", source_path=f"{base}/products/", file_format="csv",
        primary_key_columns=("product_id",), dedup_columns=("sku", "product_name"),
        quality_rules={
            "valid_product_id": "product_id IS NOT NULL",
            "valid_sku": "sku IS NOT NULL",
            "valid_price": "price IS NULL OR price >= 0",
            "valid_stock": "stock_quantity IS NULL OR stock_quantity >= 0",
        },
        read_options={"header": "true", "inferSchema": "true"},
        transformations=(cleaning.normalize_names, cleaning.standardize_boolean),
    )


def orders_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="orders", source_path=f"{base}/orders/", file_format="csv",
        primary_key_columns=("order_id",), dedup_columns=("order_id", "customer_id", "order_date"),
        quality_rules={
            "valid_order_id": "order_id IS NOT NULL",
            "valid_customer_ref": "customer_id IS NOT NULL",
            "valid_product_ref": "product_id IS NOT NULL",
            "valid_quantity": "quantity IS NULL OR quantity > 0",
            "valid_amount": "total_amount IS NULL OR total_amount >= 0",
        },
        read_options={"header": "true", "inferSchema": "true"},
    )


def employees_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="employees", source_path=f"{base}/employees/", file_format="csv",
        primary_key_columns=("employee_id",), dedup_columns=("email", "first_name", "last_name"),
        quality_rules={
            "valid_employee_id": "employee_id IS NOT NULL",
            "valid_email": "email IS NOT NULL",
            "valid_department": "department IS NOT NULL",
            "valid_salary": "salary IS NULL OR salary >= 0",
        },
        read_options={"header": "true", "inferSchema": "true"},
        transformations=(cleaning.normalize_email, cleaning.normalize_names, cleaning.add_full_name),
    )


def inventory_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="inventory", source_path=f"{base}/inventory/", file_format="csv",
        primary_key_columns=("inventory_id",), dedup_columns=("product_id", "warehouse_location"),
        quality_rules={
            "valid_inventory_id": "inventory_id IS NOT NULL",
            "valid_product_ref": "product_id IS NOT NULL",
            "valid_location": "warehouse_location IS NOT NULL",
            "valid_quantity": "quantity_on_hand IS NULL OR quantity_on_hand >= 0",
            "valid_reorder_level": "reorder_level IS NULL OR reorder_level >= 0",
        },
        read_options={"header": "true", "inferSchema": "true"},
    )


CATALOGUE: dict[str, Callable[[str], SourceSpec]] = {
    "customers": customers_spec,
    "products": products_spec,
    "orders": orders_spec,
    "employees": employees_spec,
    "inventory": inventory_spec,
}


def all_specs(base: str) -> list[SourceSpec]:
    return [f(base) for f in CATALOGUE.values()]


def spec_by_name(name: str, base: str) -> SourceSpec:
    if name not in CATALOGUE:
        raise ValueError(f"no predefined source {name!r}; choose one of {', '.join(CATALOGUE)}")
    return CATALOGUE[name](base)


def custom_spec(name: str, source_path: str, primary_key_columns: Sequence[str], **kw) -> SourceSpec:
    """Shorthand constructor."""
    return SourceSpec(name=name, source_path=source_path, primary_key_columns=tuple(primary_key_columns), **kw)


# --- extension examples (S14) -------------------------------------------------
# The example sources' rules and options as surveyed.

def suppliers_spec(base: str) -> SourceSpec:
    return custom_spec(
        "suppliers", f"{base}/suppliers/", ["supplier_id"], dedup_columns=("company_name", "contact_email"),
        quality_rules={"valid_supplier_id": "supplier_id IS NOT NULL",
                       "valid_company_name": "company_name IS NOT NULL"},
    )


def vendors_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="vendors", source_path=f"{base}/vendors/", file_format="csv",
        primary_key_columns=("vendor_id",), dedup_columns=("vendor_code", "company_name", "tax_id"),
        quality_rules={
            "valid_vendor_id": "vendor_id IS NOT NULL",
            "valid_vendor_code": "vendor_code IS NOT NULL",
            "valid_tax_id": "tax_id IS NULL OR tax_id RLIKE '^[0-9]{9}$'",
            "valid_payment_terms": 'payment_terms IN ("NET30", "NET60", "NET90", "COD")',
        },
        read_options={"header": "true", "inferSchema": "true", "delimiter": ",", "encoding": "UTF-8"},
        transformations=(cleaning.normalize_company,),
    )


def api_logs_spec(base: str) -> SourceSpec:
    return SourceSpec(
        name="api_logs", source_path=f"{base}/api_logs/", file_format="json",
        primary_key_columns=("request_id",), dedup_columns=("request_id", "timestamp"),
        quality_rules={
            "valid_request_id": "request_id IS NOT NULL",
            "valid_timestamp": "timestamp IS NOT NULL",
            "valid_status_code": "status_code >= 100 AND status_code < 600",
        },
        read_options={"multiLine": "true"},
    )
