"""Columns and types of the tables that the jobs write or only partly read.

Times are `timestamp_ntz`: the jobs compare and print wall-clock times."""

from __future__ import annotations

_LINES = {
    "ca_receipt": """
        ref_id string, ref_type int, ref_no string, ref_date timestamp_ntz, branch_id string,
        employee_name string, employee_id string, employee_code string, description string,
        total_amount decimal(21,6), cash_type int, channel_id int, to_bank_account_id string,
        to_bank_account_number string, is_reconciled boolean, object_id string,
        object_code string, object_name string, object_type int, is_auto_generate boolean,
        is_cash_sale int, approved_type int, created_date timestamp_ntz, created_by string,
        modified_date timestamp_ntz, modified_by string""",
    "ca_receipt_detail": """
        ref_detail_id string, ref_id string, ref_type int, description string,
        amount decimal(21,6), remain_amount decimal(21,6), sort_order int,
        budget_item_id string, budget_item_code string, budget_item_name string,
        order_id string, created_date timestamp_ntz, created_by string,
        modified_date timestamp_ntz, modified_by string""",
    "voucher_reference": """
        reference_id string, ref_id1 string, ref_id2 string, ref_type1 int, ref_type2 int,
        ref_no_finance1 string, ref_no_finance2 string, ref_date1 timestamp_ntz,
        ref_date2 timestamp_ntz, sort_order int, created_date timestamp_ntz,
        created_by string, modified_date timestamp_ntz, modified_by string""",
    "refno_management": """
        refno_management_id string, id string, state_key string, branch_id string,
        reftype_category int, reftype int, refno string, refid string, table_name string,
        use_branch_prefix boolean, branch_prefix string, prefix string, suffix string,
        length_of_value int, value decimal(20,0), auto_increment int,
        created_date timestamp_ntz, created_by string, modified_date timestamp_ntz,
        modified_by string""",
    "refno_state": """
        branch_id string, category_ref_type_id int, prefix string, length_of_value int,
        value decimal(20,0), max_value decimal(20,0), use_branch_prefix boolean,
        branch_prefix string, suffix string""",
    "object_reference": """
        object_reference_id string, primary_object_type int, primary_object_id string,
        reference_object_type int, used_count decimal(21,6), created_date timestamp_ntz,
        modified_date timestamp_ntz""",
    "outward": """
        ref_id string, ref_type int, ref_no string, ref_date timestamp_ntz, branch_id string,
        employee_name string, journal_memo string, total_amount decimal(21,6),
        account_object_id string, account_object_code string, account_object_name string,
        payment_type int, attachment_list string, created_date timestamp_ntz,
        created_by string, modified_date timestamp_ntz, modified_by string,
        employee_id string, channel_id int, employee_code string, object_type int""",
    "outward_detail": """
        ref_detail_id string, ref_id string, inventory_item_id string, sku_code string,
        inventory_item_name string, stock_id string, stock_name string, unit_id string,
        quantity decimal(21,6), unit_name string, unit_price decimal(21,6),
        amount decimal(21,6), stock_location_id string, stock_location_name string,
        sort_order int, inward_ref_id string, inward_ref_detail_id string, unit_list string,
        created_date timestamp_ntz, created_by string, modified_date timestamp_ntz,
        modified_by string, stock_code string, inventory_item_type int, lot_no string,
        expired_date date, drug_code string, production_date date, registration_no string,
        drug_unit_id string, drug_quantity decimal(21,6), drug_price decimal(21,6),
        drug_unit_name string, order_detail_id string, detail_parent_id string""",
}


def parse(text: str) -> dict[str, str]:
    """`name type` pairs, comma separated; a comma inside a type stays."""
    pairs = [part.split() for part in text.replace("\n", " ").split(", ")]
    return {name: kind for name, kind in pairs}


SCHEMAS = {table: parse(text) for table, text in _LINES.items()}
