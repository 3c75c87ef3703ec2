"""Retail tables derived from the TPC-H-like test data (see FIXTURES.md).

Each entry is one SELECT that Spark and DuckDB both run unchanged; a name in
braces is another entry or a stored Parquet table. The expressions are the
documented definition of the test input, so they stay SQL text: Spark runs
them to get its input DataFrames and the oracle puts the same text into CTEs.
The modulo terms plant the defects that the checks have to find.
"""

from __future__ import annotations

import re

SOURCE_TABLES = ("orders", "lineitem", "customer", "supplier", "part", "nation")

# Columns that the jobs only carry along. Every column gets its own modulus, so
# a value that lands in the wrong target column shows up in the oracle.
ORDER_PASS_THROUGH = {
    "decimal(21,6)": (
        "total_item_amount delivery_amount deposit_amount tax_amount"
        " tax_reduction_amount total_item_amount_before_tax"
        " total_item_discount_amount_before_tax discount_amount_before_tax"
        " total_item_quantity personal_tax_rate shipping_partner_amount"
        " service_tax_rate delivery_amount_before_tax delivery_tax_amount"
        " delivery_tax_reduction_amount"
    ),
    "int": (
        "unit_price_type inv_buyer_object_type shipping_partner_type"
        " ta_career_group_int_id create_platform sale_channel_id"
    ),
    "boolean": (
        "is_apply_tax is_tax_reduction is_invoice_required"
        " is_apply_tax_for_shipping_fee is_fully_returned_not_published"
        " has_tax_reduction_amount_edited is_not_calculate_tax is_customer_debt"
        " is_sign"
    ),
    "timestamp": "modified_date shipping_date cancel_date",
    "string": (
        "shipping_partner_id shipping_partner_code shipping_partner_name"
        " delivery_code page_id page_name modified_by recipient_tel"
        " recipient_name inv_email inv_buyer_legal_name inv_buyer_tax_code"
        " inv_buyer_address inv_buyer_legal_tel inv_buyer_name customer_tel"
        " customer_email partner_user_id conversation_channel_name"
        " order_id_return recipient_address ta_career_group_code"
        " inv_identify_number inv_budget_item_code inv_passport_number"
        " sale_channel_name customer_tax_code customer_identify_number"
    ),
}
LINE_PASS_THROUGH = {
    "decimal(21,6)": (
        "unit_price unit_price_before_tax discount_amount amount_before_tax"
        " tax_rate tax_amount amount_after_tax tax_reduction_amount"
        " tax_reduction_rate discount_amount_before_tax"
        " allocation_amount_before_tax pre_unit_price_before_discount"
        " pre_amount_before_discount personal_tax_rate"
        " original_tax_reduction_amount origin_quantity allocation_amount"
        " amount_after_discount allocation_used_point"
    ),
    "int": "ta_career_group_int_id",
    "boolean": (
        "is_e_invoice_component is_tax_reduction is_tax_reduction_amount_edited is_drug"
    ),
    "string": (
        "sku_code inventory_item_name unit_name ref_detail_parent_id file_name"
        " promotion_id inventory_item_name_invoice description drug_dosage"
    ),
}


def _pass_through(kinds: dict[str, str], key: str, date: str) -> str:
    parts, modulus = [], 2
    for kind, names in kinds.items():
        for name in names.split():
            modulus += 1
            rest = f"{key}%{modulus}"
            value = {
                "decimal(21,6)": f"cast({rest} as decimal(21,6))",
                "int": f"cast({rest} as int)",
                "boolean": f"case when {rest}=1 then null else {rest}=0 end",
                "timestamp": f"{date} + interval {modulus} day",
                "string": f"'{name} '||cast({rest} as string)",
            }[kind]
            parts.append(f"{value} as {name}")
    return ",\n        ".join(parts)


DERIVED: dict[str, str] = {
    "li": """
    select
        l_orderkey,
        l_partkey,
        l_suppkey,
        l_linenumber,
        max(l_quantity) as l_quantity,
        max(l_extendedprice) as l_extendedprice,
        max(l_shipdate) as l_shipdate,
        max(l_returnflag) as l_returnflag
    from {lineitem}
    group by l_orderkey, l_partkey, l_suppkey, l_linenumber""",
    "sa_order": """
    select
        'O'||cast(o_orderkey as string) as order_id,
        'DH'||lpad(cast(o_orderkey as string),7,'0') as ref_no,
        case when o_orderkey%20=0 then 550 else 549 end as ref_type,
        case o_orderkey%8 when 0 then 10 when 1 then 40 when 6 then 90 when 7 then 60 when 4 then 85 else 80 end as order_status,
        o_orderdate as ref_date,
        o_orderdate as order_date,
        case when o_orderkey%3=0 then null else o_orderdate + interval 3 day end as completed_date,
        'B'||cast(o_custkey%5 as string) as branch_id,
        case when o_orderkey%17=0 then null when o_orderkey%17=1 then '' else 'C'||cast(o_custkey as string) end as customer_id,
        'KH'||cast(o_custkey as string) as customer_code,
        c_name as customer_name,
        case o_orderkey%11 when 0 then 20 when 1 then 70 when 2 then 5 when 3 then 1 else 90 end as channel_id,
        case when o_orderkey%29=0 then null else 'S'||cast(o_orderkey%4 as string) end as stock_id,
        'Kho' as stock_name,
        case when o_orderkey%31=0 then null else o_orderkey%2 end as is_cod_paid,
        cast(o_totalprice as decimal(21,6)) as receive_amount,
        cast(case when o_orderkey%5=0 then 0 else o_totalprice end as decimal(21,6)) as remain_amount,
        cast(case when o_orderkey%7=0 then 500 else 0 end as decimal(21,6)) as debt_payment_amount,
        cast(o_totalprice as decimal(21,6)) as total_amount,
        case when o_orderkey%6=0 then '' else 'Cashier '||cast(o_orderkey%10 as string) end as cashier_name,
        case when o_orderkey%6=0 then null else 'E'||cast(o_orderkey%10 as string) end as cashier_id,
        'E'||cast(o_orderkey%10 as string) as employee_id,
        'NV'||cast(o_orderkey%10 as string) as employee_code,
        'Employee '||cast(o_orderkey%10 as string) as employee_name,
        @ORDER_PASS@
    from {orders} join {customer} on c_custkey=o_custkey""",
    "sa_order_detail": """
    select
        'O'||cast(l_orderkey as string) as order_id,
        'D'||cast(l_orderkey as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(l_linenumber as string) as order_detail_id,
        'I'||cast(l_partkey as string) as inventory_item_id,
        case when l_partkey%10=0 then 2 else 1 end as inventory_item_type,
        case when l_partkey%5=1 then 'U1' else 'U0' end as unit_id,
        cast(l_quantity as decimal(21,6)) as quantity,
        cast(l_extendedprice as decimal(21,6)) as amount,
        l_linenumber as sort_order,
        case when l_partkey%3=0 then 'L'||cast(l_partkey%9 as string) end as lot_no,
        case when l_partkey%6=0 then cast('2030-01-01' as date) end as expired_date,
        case when l_linenumber=7 then 1 when l_linenumber=6 then null else 0 end as is_return,
        @LINE_PASS@
    from {li}""",
    "sa_order_payment": """
    select
        'O'||cast(o_orderkey as string) as order_id,
        'P'||cast(o_orderkey as string)||'-'||cast(seq as string) as payment_id,
        pt as payment_type,
        cast(case when o_orderkey%53=0 then 0 else o_totalprice end as decimal(21,6)) as amount,
        case when pt in (5,15,18) then null else 'BA'||cast(o_orderkey%3 as string) end as bank_account_id,
        'ACC'||cast(o_orderkey%3 as string) as account_number
    from (select o_orderkey,o_totalprice,case o_orderkey%12 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 5 when 4 then 7 when 5 then 8 when 6 then 11 when 7 then 12 when 8 then 13 when 9 then 15 when 10 then 16 else 18 end pt,1 seq from {orders}
        union all select o_orderkey,o_totalprice,case when o_orderkey%2=1 then 5 else 11 end,2 from {orders}
        where o_orderkey%3=0) p""",
    "view_sa_order_payment": """
    select
        order_id,
        max(payment_type) as payment_type
    from {sa_order_payment}
    group by order_id""",
    "voucher_reference": """
    select
        'VR'||cast(o_orderkey as string) as reference_id,
        case when o_orderkey%9=0 then 'OUT'||cast(o_orderkey as string) else 'V'||cast(o_orderkey as string) end as ref_id1,
        'O'||cast(o_orderkey as string) as ref_id2,
        case o_orderkey%9 when 0 then 2900 when 1 then 1012 when 2 then 55041 else 55042 end as ref_type1,
        549 as ref_type2
    from {orders}
        where o_orderkey%9 in (0,1,2,3)""",
    "refno_state": """
    select
        'B'||cast(n_nationkey as string) as branch_id,
        cat as category_ref_type_id,
        case when n_nationkey=3 then null else px end as prefix,
        6 as length_of_value,
        case when n_nationkey=4 then null when n_nationkey=1 then cast(999990 as bigint)
            else cast(n_nationkey*10 as bigint) end as value,
        cast(null as string) as suffix
    from (select n_nationkey,1010 cat,'PT' px from {nation}
        where n_nationkey<5 and n_nationkey<>2
        union all select n_nationkey,2091,'XK' from {nation}
        where n_nationkey<5) n""",
    "refno_management": """
    select
        'B'||cast(n_nationkey as string) as branch_id,
        cat as reftype_category,
        case when o_orderkey%4=0 then px||'X' else px||lpad(cast(o_orderkey as string),6,'0') end as refno
    from (select n_nationkey,o_orderkey,1010 cat,'PT' px
        from {nation} join {orders} on o_orderkey%5=n_nationkey where n_nationkey<3
        union all select n_nationkey,o_orderkey,2091,'XK'
        from {nation} join {orders} on o_orderkey%5=n_nationkey
        where n_nationkey<3 and o_orderkey%3>0) m""",
    "dboption": """
    select
        'B'||cast(n_nationkey as string) as branch_id,
        'StoreRefNo' as option_id,
        'CH'||cast(n_nationkey as string) as option_value
    from {nation}
        where n_nationkey<2""",
    "object_reference": """
    select
        115 as primary_object_type,
        'C'||cast(c_custkey as string) as primary_object_id,
        1012 as reference_object_type,
        cast(1 as decimal(21,6)) as used_count
    from {customer}
        where c_custkey%2=0""",
    "led_account_object_closing": """
    select
        'C'||cast(c_custkey as string) as account_object_id,
        'B'||cast(c_custkey%5 as string) as branch_id,
        cast(c_acctbal as decimal(21,6)) as separate_debt_amount
    from {customer}
        where c_custkey%3<>0""",
    "stock": """
    select
        'S'||cast(s_suppkey as string) as stock_id,
        'KHO'||cast(s_suppkey as string) as stock_code,
        s_name as stock_name
    from {supplier}
        where s_suppkey<3""",
    "inventory_item": """
    select
        'I'||cast(p_partkey as string) as inventory_item_id,
        case when p_partkey%6=0 and p_partkey>0 then 'I'||cast(p_partkey-1 as string) end as parent_id,
        case when p_partkey%10=0 then 2 else 1 end as inventory_item_type,
        '[]' as unit_list
    from {part}""",
    "unit_convert": """
    select
        'I'||cast(p_partkey as string) as inventory_item_id,
        'U1' as unit_id,
        cast(rate as decimal(21,6)) as convert_rate
    from (select p_partkey, 12 as rate from {part} where p_partkey%5=1
        union all select p_partkey, 6 from {part} where p_partkey%35=1) u""",
    "opening_inventory_entry": """
    select
        'OP'||cast(p_partkey as string) as ref_id,
        600 as ref_type,
        cast('1994-12-31 00:00:00' as timestamp) as ref_date,
        'B0' as branch_id,
        'S'||cast(p_partkey%4 as string) as stock_id,
        'I'||cast(p_partkey as string) as inventory_item_id,
        case when p_partkey%3=0 then 'L'||cast(p_partkey%9 as string) end as lot_no,
        case when p_partkey%6=0 then cast('2030-01-01' as date) end as expired_date,
        cast(100 as decimal(21,6)) as quantity,
        cast(p_retailprice*100 as decimal(21,6)) as amount
    from {part}""",
    "inward": """
    select
        'IN'||cast(l_orderkey as string) as ref_id,
        2010 as ref_type,
        max(l_shipdate) as ref_date,
        'B'||cast(l_orderkey%5 as string) as branch_id
    from {lineitem}
        where l_returnflag='A'
        group by l_orderkey""",
    "inward_detail": """
    select
        'IN'||cast(l_orderkey as string) as ref_id,
        'IND'||cast(l_orderkey as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(l_linenumber as string) as ref_detail_id,
        'S'||cast(l_suppkey%4 as string) as stock_id,
        'I'||cast(l_partkey as string) as inventory_item_id,
        case when l_partkey%3=0 then 'L'||cast(l_partkey%9 as string) end as lot_no,
        case when l_partkey%6=0 then cast('2030-01-01' as date) end as expired_date,
        case when l_partkey%10=0 then 2 else 1 end as inventory_item_type,
        cast(l_quantity as decimal(21,6)) as quantity,
        cast(l_extendedprice as decimal(21,6)) as amount
    from {li}
        where l_returnflag='A'""",
    "outward": """
    select
        'OUT'||cast(l_orderkey as string) as ref_id,
        2900 as ref_type,
        max(l_shipdate) as ref_date,
        'B'||cast(l_orderkey%5 as string) as branch_id
    from {lineitem}
        where l_returnflag='R'
        group by l_orderkey""",
    "outward_detail": """
    select
        'OUT'||cast(l_orderkey as string) as ref_id,
        'OUTD'||cast(l_orderkey as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(l_linenumber as string) as ref_detail_id,
        'S'||cast(l_suppkey%4 as string) as stock_id,
        'I'||cast(l_partkey as string) as inventory_item_id,
        case when l_partkey%3=0 then 'L'||cast(l_partkey%9 as string) end as lot_no,
        case when l_partkey%6=0 then cast('2030-01-01' as date) end as expired_date,
        case when l_partkey%10=0 then 2 else 1 end as inventory_item_type,
        cast(l_quantity as decimal(21,6)) as quantity,
        cast(l_extendedprice as decimal(21,6)) as amount
    from {li}
        where l_returnflag='R'""",
    "transfer_stock": """
    select
        'TR'||cast(l_orderkey as string) as ref_id,
        case l_orderkey%3 when 0 then 2909 when 1 then 2910 else 2908 end as ref_type,
        max(l_shipdate) as ref_date,
        'B'||cast(l_orderkey%5 as string) as branch_id
    from {lineitem}
        where l_returnflag='N'
        group by l_orderkey""",
    "transfer_stock_detail": """
    select
        'TR'||cast(l_orderkey as string) as ref_id,
        'TRD'||cast(l_orderkey as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string)||'-'||cast(l_linenumber as string) as ref_detail_id,
        'S'||cast(l_suppkey%4 as string) as from_stock_id,
        'S'||cast((l_suppkey+1)%4 as string) as to_stock_id,
        'I'||cast(l_partkey as string) as inventory_item_id,
        case when l_partkey%3=0 then 'L'||cast(l_partkey%9 as string) end as lot_no,
        case when l_partkey%6=0 then cast('2030-01-01' as date) end as expired_date,
        case when l_partkey%10=0 then 2 else 1 end as inventory_item_type,
        cast(l_quantity as decimal(21,6)) as quantity,
        cast(l_extendedprice as decimal(21,6)) as amount
    from {li}
        where l_returnflag='N'""",
    "led_inventory_item_ledger": """
    select
        inventory_item_ledger_id,
        ref_id,
        ref_detail_id,
        ref_type,
        ref_date,
        branch_id,
        stock_id,
        inventory_item_id,
        lot_no,
        expired_date,
        main_inward_quantity,
        main_outward_quantity,
        inward_amount,
        outward_amount,
        case when stock_id in ('S0','S2') then 'LOC'||stock_id end as stock_location_id
    from (select 'G'||ref_id inventory_item_ledger_id,ref_id,cast(null as string) ref_detail_id,ref_type,ref_date,branch_id,stock_id,inventory_item_id,lot_no,expired_date,quantity main_inward_quantity,cast(0 as decimal(21,6)) main_outward_quantity,amount inward_amount,cast(0 as decimal(21,6)) outward_amount from {opening_inventory_entry}
        where cast(substr(inventory_item_id,2) as bigint)%101<>1
        union all select 'G'||x.ref_detail_id inventory_item_ledger_id,h.ref_id,x.ref_detail_id,h.ref_type,h.ref_date,h.branch_id,x.stock_id stock_id,x.inventory_item_id,x.lot_no,x.expired_date,x.quantity main_inward_quantity,cast(0 as decimal(21,6)) main_outward_quantity,x.amount inward_amount,cast(0 as decimal(21,6)) outward_amount from {inward} h join {inward_detail} x on x.ref_id=h.ref_id
        where length(x.ref_detail_id)>0 and cast(substr(x.inventory_item_id,2) as bigint)%103<>1
        union all select 'G'||x.ref_detail_id inventory_item_ledger_id,h.ref_id,x.ref_detail_id,h.ref_type,h.ref_date,h.branch_id,x.stock_id stock_id,x.inventory_item_id,x.lot_no,x.expired_date,cast(0 as decimal(21,6)) main_inward_quantity,x.quantity main_outward_quantity,cast(0 as decimal(21,6)) inward_amount,x.amount outward_amount from {outward} h join {outward_detail} x on x.ref_id=h.ref_id
        where length(x.ref_detail_id)>0 and cast(substr(x.inventory_item_id,2) as bigint)%107<>1
        union all select 'GO'||x.ref_detail_id inventory_item_ledger_id,h.ref_id,x.ref_detail_id,h.ref_type,h.ref_date,h.branch_id,x.from_stock_id stock_id,x.inventory_item_id,x.lot_no,x.expired_date,cast(0 as decimal(21,6)) main_inward_quantity,x.quantity main_outward_quantity,cast(0 as decimal(21,6)) inward_amount,x.amount outward_amount from {transfer_stock} h join {transfer_stock_detail} x on x.ref_id=h.ref_id
        where length(x.ref_detail_id)>0 and cast(substr(x.inventory_item_id,2) as bigint)%109<>1
        union all select 'GI'||x.ref_detail_id inventory_item_ledger_id,h.ref_id,x.ref_detail_id,h.ref_type,h.ref_date,h.branch_id,x.to_stock_id stock_id,x.inventory_item_id,x.lot_no,x.expired_date,x.quantity main_inward_quantity,cast(0 as decimal(21,6)) main_outward_quantity,x.amount inward_amount,cast(0 as decimal(21,6)) outward_amount from {transfer_stock} h join {transfer_stock_detail} x on x.ref_id=h.ref_id
        where length(x.ref_detail_id)>0 and cast(substr(x.inventory_item_id,2) as bigint)%113<>1) u""",
    "led_inventory_item_balance": """
    select
        max(inventory_item_ledger_id) as inventory_item_balance_id,
        inventory_item_id,
        branch_id,
        stock_id,
        cast(ref_date as date) as ref_date,
        sum(main_inward_quantity)+case when cast(substr(inventory_item_id,2) as bigint)%131=1 then 1 else 0 end as inward_quantity,
        sum(inward_amount) as inward_amount,
        sum(main_outward_quantity) as outward_quantity,
        sum(outward_amount) as outward_amount
    from {led_inventory_item_ledger}
        where cast(substr(inventory_item_id,2) as bigint)%127<>1
        group by inventory_item_id,branch_id,stock_id,cast(ref_date as date)""",
    "led_inventory_item_balance_lot": """
    select
        max(inventory_item_ledger_id) as inventory_item_balance_lot_id,
        inventory_item_id,
        branch_id,
        stock_id,
        lot_no,
        expired_date,
        cast(ref_date as date) as ref_date,
        sum(main_inward_quantity)+case when cast(substr(inventory_item_id,2) as bigint)%131=1 then 1 else 0 end as inward_quantity,
        sum(inward_amount) as inward_amount,
        sum(main_outward_quantity) as outward_quantity,
        sum(outward_amount) as outward_amount
    from {led_inventory_item_ledger}
        where cast(substr(inventory_item_id,2) as bigint)%127<>1 and lot_no is not null
        group by inventory_item_id,branch_id,stock_id,lot_no,expired_date,cast(ref_date as date)""",
    "led_inventory_item_balance_stock_location": """
    select
        max(inventory_item_ledger_id) as inventory_item_balance_stock_location_id,
        inventory_item_id,
        branch_id,
        stock_id,
        stock_location_id,
        cast(ref_date as date) as ref_date,
        sum(main_inward_quantity)+case when cast(substr(inventory_item_id,2) as bigint)%131=1 then 1 else 0 end as inward_quantity,
        sum(inward_amount) as inward_amount,
        sum(main_outward_quantity) as outward_quantity,
        sum(outward_amount) as outward_amount
    from {led_inventory_item_ledger}
        where cast(substr(inventory_item_id,2) as bigint)%127<>1 and stock_location_id is not null
        group by inventory_item_id,branch_id,stock_id,stock_location_id,cast(ref_date as date)""",
    "led_inventory_item_closing": """
    select
        max(inventory_item_ledger_id) as inventory_item_closing_id,
        inventory_item_id,
        stock_id,
        sum(main_inward_quantity-main_outward_quantity)+case when cast(substr(inventory_item_id,2) as bigint)%139=1 then 1 else 0 end as quantity,
        sum(inward_amount-outward_amount) as amount,
        cast(case when cast(substr(inventory_item_id,2) as bigint)%2=0 then 10 else 0 end as decimal(21,6)) as order_quantity
    from {led_inventory_item_ledger}
        where cast(substr(inventory_item_id,2) as bigint)%137<>1
        group by inventory_item_id,stock_id""",
    "led_inventory_item_closing_lot": """
    select
        max(inventory_item_ledger_id) as inventory_item_closing_lot_id,
        inventory_item_id,
        branch_id,
        stock_id,
        lot_no,
        expired_date,
        sum(main_inward_quantity-main_outward_quantity)+case when cast(substr(inventory_item_id,2) as bigint)%139=1 then 1 else 0 end as quantity,
        sum(inward_amount-outward_amount) as amount
    from {led_inventory_item_ledger}
        where cast(substr(inventory_item_id,2) as bigint)%137<>1 and lot_no is not null
        group by inventory_item_id,branch_id,stock_id,lot_no,expired_date""",
    "led_order_item_ledger": """
    select
        'OL'||x.order_detail_id as led_order_item_ledger_id,
        x.order_id as order_id,
        x.order_detail_id as order_detail_id,
        x.inventory_item_id as inventory_item_id,
        o.stock_id as stock_id,
        x.quantity as main_quantity
    from {sa_order_detail} x join {sa_order} o on o.order_id=x.order_id
        where cast(substr(x.inventory_item_id,2) as bigint)%149<>1""",
    "led_account_object_ledger": """
    select
        'V'||cast(o_orderkey as string) as ref_id,
        case o_orderkey%6 when 0 then 1021 when 1 then 55051 when 2 then 304 when 3 then 1011 when 4 then 55041 else 5513 end as ref_type,
        case when o_orderkey%37=0 then null else 'C'||cast(o_custkey as string) end as account_object_id,
        'B'||cast(o_custkey%5 as string) as branch_id,
        cast(o_totalprice as decimal(21,6)) as amount,
        cast(case when o_orderkey%41=1 then 0 else o_totalprice end as decimal(21,6)) as pay_amount
    from {orders}
        where o_orderkey%47<>1""",
    "ca_payment": """
    select
        'V'||cast(o_orderkey as string) as ref_id
    from {orders}
        where o_orderkey%6 in (0,1) and o_orderkey%19<>1""",
    "ca_receipt": """
    select
        'V'||cast(o_orderkey as string) as ref_id
    from {orders}
        where o_orderkey%6 in (3,4) and o_orderkey%23<>1""",
    "vendor_payment": """
    select
        'V'||cast(o_orderkey as string) as ref_id,
        case o_orderkey%6 when 0 then 1021 when 1 then 55051 when 2 then 304 when 3 then 1011 when 4 then 55041 else 5513 end as ref_type,
        case when o_orderkey%37=0 then null else 'C'||cast(o_custkey as string) end as account_object_id,
        'B'||cast(o_custkey%5 as string) as branch_id,
        case when o_orderkey%43=1 then null else 'PN'||cast(o_custkey as string) end as debt_ref_id,
        'PN-'||cast(o_custkey as string) as debt_ref_no,
        cast(1500000 as decimal(21,6)) as debt_amount,
        cast(case when o_orderkey%29=1 then o_totalprice-10 when o_orderkey%31=1 then o_totalprice+10 else o_totalprice end as decimal(21,6)) as pay_amount
    from {orders}
        where o_orderkey%6 in (0,1,2) and o_orderkey%13<>1""",
    "customer_receipt": """
    select
        'V'||cast(o_orderkey as string) as ref_id,
        case o_orderkey%6 when 0 then 1021 when 1 then 55051 when 2 then 304 when 3 then 1011 when 4 then 55041 else 5513 end as ref_type,
        case when o_orderkey%37=0 then null else 'C'||cast(o_custkey as string) end as account_object_id,
        'B'||cast(o_custkey%5 as string) as branch_id,
        case when o_orderkey%43=1 then null else 'PN'||cast(o_custkey as string) end as debt_ref_id,
        'PN-'||cast(o_custkey as string) as debt_ref_no,
        cast(1500000 as decimal(21,6)) as debt_amount,
        cast(case when o_orderkey%29=1 then o_totalprice-10 when o_orderkey%31=1 then o_totalprice+10 else o_totalprice end as decimal(21,6)) as pay_amount
    from {orders}
        where o_orderkey%6 in (3,4,5) and o_orderkey%13<>1""",
    "general_order": """
    select
        order_id,
        case when cast(substr(order_id,2) as bigint)%15=1 then 'OLD' else ref_no end as ref_no,
        case when cast(substr(order_id,2) as bigint)%14=1 then null when cast(substr(order_id,2) as bigint)%14=3 then 10 else order_status end as order_status
    from {sa_order}
        where cast(substr(order_id,2) as bigint)%10<7""",
    "general_order_detail": """
    select
        order_id,
        order_detail_id
    from {sa_order_detail}
        where cast(substr(order_id,2) as bigint)%10<6""",
}
DERIVED["sa_order"] = DERIVED["sa_order"].replace(
    "@ORDER_PASS@", _pass_through(ORDER_PASS_THROUGH, "o_orderkey", "o_orderdate")
)
DERIVED["sa_order_detail"] = DERIVED["sa_order_detail"].replace(
    "@LINE_PASS@", _pass_through(LINE_PASS_THROUGH, "l_partkey", "l_shipdate")
)


def depends_on(name: str) -> list[str]:
    """Tables that the definition of `name` reads, in order of first use."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", DERIVED[name])))


def expression_of(name: str, column: str) -> str:
    """What a column of `name` is made from: each stands on a line of its own."""
    return re.search(rf"^\s*(.+) as {column},?$", DERIVED[name], re.MULTILINE).group(1)


def with_clause(*names: str) -> str:
    """`name AS (...)` list for the given derived tables and all they need."""
    done: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in done or name in SOURCE_TABLES:
            return
        for other in depends_on(name):
            visit(other)
        done[name] = re.sub(r"\{(\w+)\}", r"\1", DERIVED[name])

    for name in names:
        visit(name)
    return ",\n".join(f"{name} as ({text})" for name, text in done.items())
