"""Declared schemas: the given tables, and the raw, staging, audit and log tables."""

from __future__ import annotations

# The given tables, so that a read needs no footer scan.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Landing: text as it came.
RAW_SALES = (
    "order_id string, order_line_id string, customer_id string, product_id string, store_id string, "
    "transaction_date string, quantity string, unit_price string, discount_percent string, total_amount string, "
    "payment_method string, order_status string"
)
RAW_CUSTOMERS = (
    "customer_id string, first_name string, last_name string, email string, phone string, date_of_birth string, "
    "gender string, registration_date string, customer_segment string, address_line1 string, city string, "
    "state string, postal_code string, country string, loyalty_points string, preferred_contact string, "
    "is_active string"
)
RAW_INVENTORY = (
    "inventory_id string, product_id string, store_id string, quantity_on_hand string, quantity_reserved string, "
    "reorder_point string, reorder_qty string, last_restock_date string, snapshot_timestamp string"
)
STORES = (
    "store_id string, store_name string, store_type string, city string, state string, region string, "
    "country string, is_active boolean, open_date string"
)

# Audit and registry.
LOAD_AUDIT = (
    "batch_id string, table_name string, source_stage string, file_pattern string, load_start_time timestamp_ntz, "
    "load_end_time timestamp_ntz, rows_loaded bigint, rows_rejected bigint, status string, error_message string"
)
FILE_REGISTRY = (
    "file_path string, file_name string, file_size_bytes bigint, file_modified_date timestamp_ntz, "
    "process_status string, process_timestamp timestamp_ntz, batch_id string, rows_loaded bigint, "
    "error_message string"
)
QUALITY_RESULT = (
    "layer_name string, table_name string, rule_name string, rule_category string, records_checked bigint, "
    "records_passed bigint, records_failed bigint, pass_rate decimal(5,2), status string, threshold decimal(5,2), "
    "details string"
)
