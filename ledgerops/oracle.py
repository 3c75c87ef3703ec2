"""The queries as DuckDB SQL over the same Parquet tables.

Each text holds the derived tables it needs as CTEs, then the operator in plain
join-and-subquery form, which is not how the Spark operators compute it."""

from __future__ import annotations

import re

from ledgerops.functions import codes
from ledgerops.operators import inventory_checks as inv
from ledgerops.operators import sync
from ledgerops.queries import BATCH, CAP
from ledgerops.sources.derived import DERIVED, with_clause
from ledgerops.sources.schemas import SCHEMAS

NOW = "timestamp '2026-01-01 00:00:00'"
ZERO = "cast(0 as decimal(38,6))"


def _type(kind: str) -> str:
    return {"string": "varchar", "timestamp_ntz": "timestamp"}.get(kind, kind)


def _project(schema: dict[str, str], values: dict[str, str], have: set[str] | None = None) -> str:
    """Select list in schema order: a given value, else the column itself, else null."""
    parts = []
    for name, kind in schema.items():
        value = values.get(name, name if have is None or name in have else "null")
        parts.append(f"cast({value} as {_type(kind)}) as {name}")
    return ",\n".join(parts)


def _id(*parts: str) -> str:
    text = ", ".join(f"coalesce(cast({part} as varchar), '')" for part in parts)
    digest = f"sha256(concat_ws('|', {text}))"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "||'-'||".join(f"substr({digest}, {start}, {length})" for start, length in cuts)


def _list(values) -> str:
    return ", ".join(str(value) for value in values)


# --- stages shared by several oracles, each a CTE --------------------------------------

DONE = f"order_status in ({_list(codes.ORDER_DONE)}) and ref_type = {codes.SALES_ORDER}"


def _linked(types) -> str:
    return f"""exists (select 1 from voucher_reference v
        where v.ref_id2 = o.order_id and v.ref_type1 in ({_list(types)}))"""


def _candidate(
    source: int, types: str, where: str, kind: str, amount: str, cash: int, remain: str,
    intended: bool = False, join: str = "",
) -> str:
    once = (
        f"""and p.payment_id = (select min(x.payment_id) from sa_order_payment x
        where x.order_id = p.order_id and x.amount > 0 and x.payment_type {types})"""
        if intended
        else ""
    )
    return f"""
    select {source} as source, o.*, p.payment_id, p.payment_type, p.bank_account_id,
        p.account_number, {kind} as receipt_ref_type, {amount} as receipt_amount,
        {cash} as receipt_is_cash_sale, {remain} as receipt_remain_amount
    from target_rows o
    join sa_order_payment p on p.order_id = o.order_id and p.amount > 0
        and p.payment_type {types}
    {join}
    where {where} {once}"""


CASH = _list(codes.CASH_PAYMENT)


def _candidates(intended: bool) -> str:
    sale = f"not in ({_list(codes.NOT_A_SALE_PAYMENT)})"
    debt = f"in ({_list(codes.DEBT_PAYMENT)})"
    return " union all ".join(
        [
            _candidate(
                1, sale,
                f"""o.receive_amount > 0 and not (o.is_cod_paid = 1 and o.channel_id <> 90)
                and not (o.channel_id = 90 and o.debt_payment_amount > 0)
                and not {_linked(codes.RECEIPT_LINKS)}""",
                f"""case when p.payment_type = 16 then 55044
                when p.payment_type in ({CASH}) then 1012 else 55042 end""",
                "p.amount", 1, "p.amount",
            ),
            _candidate(
                2, sale,
                f"""o.is_cod_paid = 1 and o.channel_id <> 90 and o.remain_amount > 0
                and not {_linked(codes.COD_LINKS)}""",
                f"case when p.payment_type in ({CASH}) then 1012 else 55042 end",
                "o.remain_amount", 1, "o.remain_amount", intended,
            ),
            _candidate(
                3, debt,
                f"""o.receive_amount > 0 and o.channel_id = 90 and o.debt_payment_amount > 0
                and not {_linked(codes.DEBT_LINKS)}""",
                "case when p.payment_type = 15 then 1011 else 55041 end",
                "o.debt_payment_amount", 0, "coalesce(d.debt, 0)", intended,
                """left join (select account_object_id, branch_id, max(separate_debt_amount) debt
                from led_account_object_closing group by all) d
                on d.account_object_id = o.customer_id and d.branch_id = o.branch_id""",
            ),
        ]
    )


def _sequence(order: str, branch: bool) -> str:
    part = "partition by branch_id" if branch else ""
    first = order if branch else f"branch_id nulls first, {order}"
    return f"row_number() over ({part} order by {first})"


RECEIPT_ORDER = (
    "ref_date nulls first, ref_no nulls first, order_id, payment_id, receipt_ref_type"
)
ISSUE_ORDER = "ref_date nulls first, ref_no nulls first, order_id"
NUMBER = """case when d.option_value is null then '' else d.option_value || '-' end
    || coalesce(s.prefix, '')
    || lpad(cast(coalesce(s.value, 0) + n.row_num as varchar), s.length_of_value, '0')"""
# as intended a number keeps all its digits
NUMBER_KEPT = NUMBER.replace(
    "s.length_of_value, '0'",
    "cast(greatest(s.length_of_value, length(cast(coalesce(s.value, 0) + n.row_num as varchar))) as int), '0'",
)
STATE = """join refno_state s on s.branch_id = n.branch_id and s.category_ref_type_id = {}
    left join dboption d on d.branch_id = s.branch_id and d.option_id = 'StoreRefNo'"""
STATE_COLUMNS = """s.category_ref_type_id, s.prefix, s.length_of_value, s.suffix, s.value,
    n.row_num"""

STAGES: dict[str, str] = {
    "target_rows": f"""
    select o.* from sa_order o
    where {DONE} and not {_linked([codes.STOCK_ISSUE])}
      and exists (select 1 from sa_order_detail x
        where x.order_id = o.order_id and x.inventory_item_type = 1)""",
    "candidates": _candidates(False),
    "candidates_once": _candidates(True),
    "numbered": f"select *, {_sequence(RECEIPT_ORDER, False)} as row_num from candidates",
    "numbered_in_branch": f"""
    select *, {_sequence(RECEIPT_ORDER, True)} as row_num from candidates_once""",
    "receipt": f"""
    select {_id("'receipt'", "n.order_id", "n.payment_id", "n.receipt_ref_type", "n.row_num")}
            as ref_id,
        n.receipt_ref_type as ref_type, {NUMBER} as ref_no,
        coalesce(n.completed_date, n.ref_date, n.order_date) as ref_date, n.branch_id,
        case when n.cashier_name <> '' then n.cashier_name else n.employee_name end
            as employee_name,
        coalesce(n.cashier_id, n.employee_id) as employee_id, n.employee_code,
        case when n.source = 3 then 'Thu tiền bán hàng từ ' || n.customer_name
            when n.payment_type = 16 then 'Thu đặt cọc/trả trước đơn hàng ' || n.ref_no
            else 'Thu tiền bán hàng đơn hàng ' || n.ref_no end as description,
        n.receipt_amount as total_amount,
        case when n.payment_type in (5, 15, 18, 20, 21) then 1 else 2 end as cash_type,
        n.receipt_is_cash_sale as is_cash_sale, n.channel_id,
        n.bank_account_id as to_bank_account_id, n.account_number as to_bank_account_number,
        coalesce(n.payment_type not in (2, 3, 12, 13), true) as is_reconciled,
        n.customer_id as object_id, n.customer_code as object_code,
        n.customer_name as object_name,
        case when n.customer_id is not null then 1 end as object_type,
        n.receipt_remain_amount, n.order_id, n.ref_no as order_no, n.ref_date as order_date,
        n.ref_type as order_ref_type, {STATE_COLUMNS}
    from numbered n {STATE.format(codes.RECEIPT_CATEGORY)}""",
    "issue_numbered": f"select *, {_sequence(ISSUE_ORDER, False)} as row_num from target_rows",
    "issue": f"""
    select {_id("'issue'", "n.order_id", "n.row_num")} as ref_id,
        {codes.STOCK_ISSUE} as ref_type, {NUMBER} as ref_no, n.ref_date, n.branch_id,
        'Xuất kho bán hàng theo đơn hàng số ' || n.ref_no as journal_memo,
        n.customer_id as account_object_id, n.customer_code as account_object_code,
        n.customer_name as account_object_name, n.channel_id, n.stock_id, n.order_id,
        n.ref_no as order_no, n.ref_date as order_date, n.ref_type as order_ref_type,
        {STATE_COLUMNS}
    from issue_numbered n {STATE.format(codes.ISSUE_CATEGORY)}""",
    "issue_line": f"""
    select {_id("'issue line'", "i.ref_id", "x.order_detail_id")} as ref_detail_id, i.ref_id,
        i.ref_date, x.*, x.ref_detail_parent_id as detail_parent_id, i.stock_id, k.stock_name,
        k.stock_code, m.unit_list, m.parent_id
    from issue i
    join stock k on k.stock_id = i.stock_id
    join sa_order_detail x on x.order_id = i.order_id and coalesce(x.is_return, 0) = 0
    join inventory_item m on m.inventory_item_id = x.inventory_item_id
        and m.inventory_item_type = 1""",
    "probe": "select distinct inventory_item_id, stock_id, ref_date from issue_line",
    "on_hand": """
    select l.inventory_item_id, l.stock_id, l.ref_date,
        cast(sum(coalesce(main_inward_quantity, 0) - coalesce(main_outward_quantity, 0))
            as decimal(38,6)) as closing_quantity,
        cast(sum(coalesce(inward_amount, 0) - coalesce(outward_amount, 0))
            as decimal(38,6)) as closing_amount
    from led_inventory_item_ledger l join probe p
        on p.inventory_item_id = l.inventory_item_id and p.stock_id = l.stock_id
        and p.ref_date > l.ref_date
    group by all""",
    "on_hand_asof": """
    select p.inventory_item_id, p.stock_id, p.ref_date,
        cast(sum(coalesce(main_inward_quantity, 0) - coalesce(main_outward_quantity, 0))
            as decimal(38,6)) as closing_quantity,
        cast(sum(coalesce(inward_amount, 0) - coalesce(outward_amount, 0))
            as decimal(38,6)) as closing_amount
    from led_inventory_item_ledger l join probe p
        on p.inventory_item_id = l.inventory_item_id and p.stock_id = l.stock_id
        and p.ref_date > l.ref_date
    group by all""",
}


def _whole(value: str) -> str:
    """Rounded half away from zero; double division first settles at eight decimals."""
    return f"cast(cast(abs({value}) as decimal(30,8)) as decimal(21,0))"


def _costed(on_hand: str, intended: bool) -> str:
    enough = "* quantity" if intended else ""
    return f"""
    select ref_id, ref_detail_id, order_detail_id, inventory_item_id, stock_id, quantity,
        cast(case when held is null then 0
            when quantity * rate >= held then {_whole("worth * rate / (quantity * rate)")}
            when held > 0 then {_whole("worth * rate / held")} else 0 end
            as decimal(21,6)) as unit_price,
        cast(case when held is null then 0
            when quantity * rate >= held then {_whole("worth")}
            when held > 0 then {_whole(f"worth * rate {enough} / held")} else 0 end
            as decimal(21,6)) as amount,
        held is not null as priced
    from (
        select x.*, cast(h.closing_quantity as decimal(21,6)) as held,
            cast(h.closing_amount as double) as worth,
            cast(coalesce(u.rate, 1) as decimal(12,6)) as rate
        from issue_line x
        left join {on_hand} h on h.inventory_item_id = x.inventory_item_id
            and h.stock_id = x.stock_id and h.ref_date = x.ref_date
        left join (select inventory_item_id, unit_id, max(convert_rate) as rate
            from unit_convert group by all) u
            on u.inventory_item_id = coalesce(x.parent_id, x.inventory_item_id)
            and u.unit_id = x.unit_id
    ) f"""


STAGES["costed"] = _costed("on_hand", False)
STAGES["costed_asof"] = _costed("on_hand_asof", True)
SIGNED = {
    "receipt": {
        "created_date": NOW, "created_by": "'script'", "modified_date": NOW,
        "modified_by": "null",
    },
    "issue": {
        "created_date": NOW, "created_by": "null", "modified_date": NOW,
        "modified_by": f"'{codes.EDITOR}'",
    },
}


def _link_select(stage: str) -> str:
    values = {
        "reference_id": _id("'link'", "ref_id"),
        "ref_id1": "ref_id",
        "ref_id2": "order_id",
        "ref_type1": "ref_type",
        "ref_type2": "order_ref_type",
        "ref_no_finance1": "ref_no",
        "ref_no_finance2": "order_no",
        "ref_date1": "ref_date",
        "ref_date2": "order_date",
        "sort_order": "0",
        **SIGNED[stage],
    }
    return f"select {_project(SCHEMAS['voucher_reference'], values)} from {stage}"


def _registry_select(stage: str, table: str) -> str:
    prefix = "coalesce(prefix, '')" if stage == "receipt" else "prefix"
    values = {
        "refno_management_id": _id("'registry'", "ref_id"),
        "id": "branch_id || '|' || category_ref_type_id || '|' || ref_no",
        "state_key": f"""branch_id || '|' || category_ref_type_id || '|' || {prefix}
            || '|' || length_of_value""",
        "reftype_category": "category_ref_type_id",
        "reftype": "ref_type",
        "refno": "ref_no",
        "refid": "ref_id",
        "table_name": f"'{table}'",
        "use_branch_prefix": "null",
        "branch_prefix": "null",
        "auto_increment": "1",
        **SIGNED[stage],
    }
    return f"select {_project(SCHEMAS['refno_management'], values)} from {stage}"


STAGES["link"] = f"{_link_select('receipt')} union all {_link_select('issue')}"
STAGES["registry"] = (
    f"{_registry_select('receipt', 'ca_receipt')}"
    f" union all {_registry_select('issue', 'outward')}"
)


def _use(code: int, column: str, kind: str, stage: str) -> str:
    return f"""select {code} as primary_object_type, {column} as primary_object_id,
        {kind} as reference_object_type, cast(count(*) as decimal(21,6)) as used_count
        from {stage} where {column} is not null group by all"""


STAGES["receipt_use"] = " union all ".join(
    [
        _use(115, "object_id", "ref_type", "receipt"),
        _use(113, "to_bank_account_id", "ref_type", "receipt"),
        _use(2, "employee_id", "ref_type", "receipt"),
    ]
)
STAGES["issue_use"] = " union all ".join(
    [
        _use(115, "account_object_id", "2091", "issue"),
        _use(100, "inventory_item_id", "2091", "issue_line"),
        _use(104, "stock_id", "2091", "issue_line"),
    ]
)
STAGES["uses"] = "select * from receipt_use union all select * from issue_use"


def _stages_in(text: str) -> list[str]:
    """Stages that the text needs, each after the ones it needs itself."""
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b(?:from|join)\s+(\w+)", sql):
            if name in STAGES and name not in found:
                visit(STAGES[name])
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def _complete(text: str) -> str:
    """Put the derived tables and stages a text uses in front of it as CTEs."""
    stages = _stages_in(text)
    every = " ".join([text, *[STAGES[name] for name in stages]])
    names = [name for name in re.findall(r"\b(?:from|join)\s+(\w+)", every) if name in DERIVED]
    ctes = [with_clause(*names)] if names else []
    ctes += [f"{name} as ({STAGES[name]})" for name in stages]
    return f"with {', '.join(ctes)}\n{text}"


# --- inventory checks ---------------------------------------------------------------------


def _stock_finding(kind: str, note: str, values: dict[str, str], rest: str) -> str:
    values = {"discrepancy_type": f"'{kind}'", "note": note, **values}
    return f"select {_project(inv.FINDING, values, set())} {rest}"


LOTS = """coalesce(l.lot_no, '') = coalesce(x.lot_no, '')
    and coalesce(l.expired_date, date '1900-01-01') = coalesce(x.expired_date, date '1900-01-01')"""
LINE_KEY = """l.ref_id = h.ref_id and l.ref_detail_id = x.ref_detail_id
    and l.ref_type = h.ref_type and l.inventory_item_id = x.inventory_item_id"""
LINE = {
    "ref_type": "h.ref_type", "ref_id": "h.ref_id", "ref_detail_id": "x.ref_detail_id",
    "ref_date": "h.ref_date", "branch_id": "h.branch_id", "stock_id": "x.stock_id",
    "inventory_item_id": "x.inventory_item_id", "lot_no": "x.lot_no",
    "expired_date": "x.expired_date",
}


def _unposted(kind: str, note: str, header: str, key: str, more: str = "", **values: str) -> str:
    return _stock_finding(
        kind, f"'{note}'", {**LINE, **values},
        f"""from {header} h join {header}_detail x on x.ref_id = h.ref_id
        where not exists (select 1 from led_inventory_item_ledger l
            where {LINE_KEY} and {LOTS} and {key}) {more}""",
    )


def _side(column: str, alias: str) -> str:
    """One row per line key of the ledger, with the number of its rows."""
    return f"""left join (select ref_id, ref_detail_id, ref_type, inventory_item_id, stock_id,
            coalesce(lot_no, '') as lot_no,
            coalesce(expired_date, date '1900-01-01') as expired_date, count(*) as copies
            from led_inventory_item_ledger group by all) {alias}
        on {LINE_KEY.replace('l.', alias + '.')}
        and {alias}.lot_no = coalesce(x.lot_no, '')
        and {alias}.expired_date = coalesce(x.expired_date, date '1900-01-01')
        and {alias}.stock_id = x.{column}"""


def _level(level: inv.Level) -> tuple[str, dict[str, str]]:
    keys = [name for name in level.keys]
    day = "cast(ref_date as date) as day," if level.daily else "max(ref_date) as last_date,"
    needs = f"where {level.needs} is not null" if level.needs else ""
    if level.daily:
        sums = """sum(main_inward_quantity) as inward_quantity, sum(inward_amount) as inward_amount,
            sum(main_outward_quantity) as outward_quantity,
            sum(outward_amount) as outward_amount"""
        measures = inv.DAILY_MEASURES
    else:
        sums = """sum(main_inward_quantity - main_outward_quantity) as quantity,
            sum(inward_amount - outward_amount) as amount"""
        measures = inv.CLOSING_MEASURES
    group = ", ".join(keys + (["cast(ref_date as date)"] if level.daily else []))
    same = " and ".join(
        f"b.{name} = a.{name}"
        if name != "expired_date"
        else "coalesce(b.expired_date, date '1900-01-01') = coalesce(a.expired_date, date '1900-01-01')"
        for name in keys
    )
    same += " and b.ref_date = a.day" if level.daily else ""
    differs = " or ".join(f"abs(a.{m} - coalesce(b.{m}, 0)) > 0" for m in measures)
    row = f"b.{level.row_id}"
    if level.daily:
        wrong = f"{row} is null or {differs}"
    else:
        wrong = f"({row} is null and a.quantity <> 0) or ({row} is not null and ({differs}))"
    text = f"""from (select {', '.join(keys)}, {day} {sums} from led_inventory_item_ledger
        {needs} group by {group}) a left join {level.table} b on {same} where {wrong}"""
    number = "cast(cast(coalesce({}, 0) as decimal(38,6)) as varchar)"
    if level.daily:
        shown = [
            f"'NhậpSL=' || {number.format(side + '.inward_quantity')}"
            f" || ' | XuấtSL=' || {number.format(side + '.outward_quantity')}"
            for side in "ab"
        ]
    else:
        shown = [
            f"'SL lũy kế theo sổ NK=' || {number.format('a.quantity')}",
            f"'{level.label}' || {number.format('b.quantity')}",
        ]
    values = {
        "ref_date": "a.day" if level.daily else "a.last_date",
        "stock_id": "a.stock_id",
        "inventory_item_id": "a.inventory_item_id",
        "ledger_value": shown[0],
        "compare_value": shown[1],
    }
    if "lot_no" in keys:
        values |= {"lot_no": "a.lot_no", "expired_date": "a.expired_date"}
    extra = {}
    for m in measures:
        extra[f"ledger_{m}"], extra[f"stored_{m}"] = f"a.{m}", f"b.{m}"
    note = f"'{level.note}'"
    if "stock_location_id" in keys:
        note += " || a.stock_location_id"
    return text, {"discrepancy_type": f"'{level.kind}'", "note": note, **values}, extra


def _level_sql(level: inv.Level, measures: bool) -> str:
    text, values, extra = _level(level)
    schema = dict(inv.FINDING)
    if measures:
        schema |= {name: "decimal(38,6)" for name in extra}
        values = values | extra
    return f"select {_project(schema, values, set())} {text}"


def _ordered(measures: bool) -> str:
    number = "cast(cast(coalesce({}, 0) as decimal(38,6)) as varchar)"
    values = {
        "discrepancy_type": "'ORDER_QUANTITY_CLOSING_MISMATCH'",
        "stock_id": "a.stock_id",
        "inventory_item_id": "a.inventory_item_id",
        "ledger_value": f"'SL đơn hàng theo sổ NK=' || {number.format('a.quantity')}",
        "compare_value": f"'SL order_quantity sổ tồn cuối=' || {number.format('c.order_quantity')}",
        "note": f"'{inv.ORDER_QUANTITY_NOTE}'",
    }
    schema = dict(inv.FINDING)
    if measures:
        schema |= {"ledger_quantity": "decimal(38,6)", "stored_quantity": "decimal(38,6)"}
        values |= {"ledger_quantity": "a.quantity", "stored_quantity": "c.order_quantity"}
    return f"""select {_project(schema, values, set())}
    from (select inventory_item_id, stock_id, sum(main_quantity) as quantity
        from led_order_item_ledger group by inventory_item_id, stock_id) a
    left join led_inventory_item_closing c
        on c.inventory_item_id = a.inventory_item_id and c.stock_id = a.stock_id
    where c.inventory_item_closing_id is null
        or abs(a.quantity - coalesce(c.order_quantity, 0)) > 0"""


def _inventory(measures: bool) -> dict[str, str]:
    stock, branch = "l.stock_id = x.{}", "l.branch_id = h.branch_id"
    return {
        "inv1_opening_not_in_ledger": _stock_finding(
            "OPENING_LEDGER_MISMATCH", f"'{inv.OPENING_NOTE}'",
            {**{k: v.replace("h.", "x.") for k, v in LINE.items()}, "ref_detail_id": "null"},
            f"""from opening_inventory_entry x where not exists (
            select 1 from led_inventory_item_ledger l where l.ref_id = x.ref_id
            and l.ref_type = x.ref_type and l.inventory_item_id = x.inventory_item_id
            and l.stock_id = x.stock_id and l.branch_id = x.branch_id and {LOTS})""",
        ),
        "inv2_inward_not_in_ledger": _unposted(
            "INWARD_LEDGER_MISMATCH", inv.INWARD_NOTE, "inward", branch,
            "and x.inventory_item_type = 1",
        ),
        "inv3_outward_not_in_ledger": _unposted(
            "OUTWARD_LEDGER_MISMATCH", inv.OUTWARD_NOTE, "outward", branch
        ),
        "inv4_transfer_out_not_in_ledger": _unposted(
            "TRANSFER_OUT_LEDGER_MISMATCH", inv.TRANSFER_OUT_NOTE, "transfer_stock",
            stock.format("from_stock_id") + " and l.main_outward_quantity > 0",
            stock_id="x.from_stock_id",
        ),
        "inv5_transfer_in_not_in_ledger": _unposted(
            "TRANSFER_IN_LEDGER_MISMATCH", inv.TRANSFER_IN_NOTE, "transfer_stock",
            stock.format("to_stock_id") + " and l.main_inward_quantity > 0",
            stock_id="x.to_stock_id",
        ),
        "inv6_transfer_either_not_in_ledger": _stock_finding(
            "TRANSFER_INOUT_LEDGER_MISMATCH",
            f"""case when o.ref_id is not null then '{inv.IN_SIDE_NOTE}'
            when i.ref_id is not null then '{inv.OUT_SIDE_NOTE}'
            else '{inv.BOTH_SIDES_NOTE}' end""",
            {**LINE, "stock_id": """case when o.ref_id is null then x.from_stock_id
            else x.to_stock_id end"""},
            f"""from transfer_stock h join transfer_stock_detail x on x.ref_id = h.ref_id
            {_side("from_stock_id", "o")} {_side("to_stock_id", "i")},
            range(coalesce(o.copies, i.copies, 1)) each(copy)
            where h.ref_type in (2909, 2910) and (o.ref_id is null or i.ref_id is null)""",
        ),
        "inv7_ledger_vs_balance": _level_sql(inv.BALANCE, measures),
        "inv8_ledger_vs_balance_lot": _level_sql(inv.BALANCE_LOT, measures),
        "inv9_ledger_vs_balance_location": _level_sql(inv.BALANCE_LOCATION, measures),
        "inv10_ledger_vs_closing": _level_sql(inv.CLOSING, measures),
        "inv11_ledger_vs_closing_lot": _level_sql(inv.CLOSING_LOT, measures),
        "inv13_order_not_in_ledger": _stock_finding(
            "ORDER_LEDGER_MISMATCH", f"'{inv.ORDER_LEDGER_NOTE}'",
            {"ref_id": "h.order_id", "ref_detail_id": "x.order_detail_id",
             "ref_date": "h.order_date", "inventory_item_id": "x.inventory_item_id"},
            """from sa_order h join sa_order_detail x on x.order_id = h.order_id
            where x.inventory_item_type = 1 and h.order_status between 6 and 49
            and not exists (select 1 from led_order_item_ledger l
                where l.order_id = h.order_id and l.order_detail_id = x.order_detail_id)""",
        ),
        "inv14_ordered_vs_closing": _ordered(measures),
    }


# --- receivable checks -----------------------------------------------------------------------


def _account_finding(check: str, key: str, code: str, rest: str, **amounts: str) -> str:
    fields = {
        name: amounts.get(name, ZERO)
        for name in (
            "expected_amount", "actual_amount", "expected_pay_amount", "actual_pay_amount"
        )
    }
    columns = ", ".join(f"cast({value} as decimal(38,6)) as {name}" for name, value in fields.items())
    return f"""select sha256(concat_ws('|', '{check}', {key})) as business_key,
        'check={check};' || {code} as business_code,
        ref_id, ref_type, account_object_id, branch_id, {columns} {rest}"""


VOUCHER_KEY = "ref_id, ref_type, coalesce(account_object_id, ''), coalesce(branch_id, '')"
VOUCHER_CODE = "'ref=' || ref_id || ';type=' || ref_type"


def _overpaid(table: str, side: str, ref_type: int) -> str:
    return f"""select '{side}' as side, debt_ref_id as ref_id, {ref_type} as ref_type,
        account_object_id, max(branch_id) as branch_id, max(debt_ref_no) as debt_ref_no,
        max(debt_amount) as debt, sum(pay_amount) as paid
    from {table} where debt_ref_id is not null and pay_amount > 0
    group by account_object_id, debt_ref_id
    having sum(pay_amount) - max(debt_amount) > 0.0001"""


def _allocated(table: str, types: str, source: str) -> str:
    return f"""select p.ref_id, p.ref_type, p.account_object_id, p.branch_id,
        sum(p.pay_amount) as paid,
        p.ref_id in (select ref_id from led_account_object_ledger) as in_ledger,
        p.ref_id in (select ref_id from {source}) as in_source
    from {table} p where p.ref_type in ({types})
    group by p.ref_id, p.ref_type, p.account_object_id, p.branch_id"""


RECEIVABLE = {
    "ar2_ledger_without_source": _account_finding(
        "LEDGER_ORPHAN", VOUCHER_KEY, VOUCHER_CODE,
        """from (select ref_id, ref_type, account_object_id, branch_id,
            sum(coalesce(amount, 0)) as amount, sum(coalesce(pay_amount, 0)) as paid
        from led_account_object_ledger l
        where (ref_type in (1021, 55051) and ref_id not in (select ref_id from ca_payment))
            or (ref_type in (1011, 55041) and ref_id not in (select ref_id from ca_receipt))
        group by all) x""",
        actual_amount="amount", actual_pay_amount="paid",
    ),
    "ar3_debt_over_allocated": _account_finding(
        "OVER_ALLOCATED", "side, ref_id, coalesce(account_object_id, '')",
        "'src=' || side || ';debt_ref=' || ref_id || ';no=' || coalesce(debt_ref_no, '')",
        f"""from ({_overpaid('vendor_payment', 'VENDOR', 301)}
        union all {_overpaid('customer_receipt', 'CUSTOMER', 0)}) x""",
        expected_amount="debt", actual_amount="paid",
    ),
    "ar4_allocation_vs_ledger": _account_finding(
        "ALLOC_VS_LEDGER", VOUCHER_KEY,
        f"""{VOUCHER_CODE} || case when found is null then ';not_allocated'
            when allocated < paid then ';under_allocated' else ';over_allocated' end""",
        """from (select l.*, a.ref_id as found, a.allocated
        from (select ref_id, ref_type, account_object_id, branch_id, sum(pay_amount) as paid
            from led_account_object_ledger
            where pay_amount > 0 and ref_type in (304, 1011, 1021, 5513, 55041, 55051)
            group by all) l
        left join (select ref_id, account_object_id, sum(pay_amount) as allocated
            from (select ref_id, account_object_id, pay_amount from vendor_payment
                union all
                select ref_id, account_object_id, pay_amount from customer_receipt) u
            group by all) a
            on a.ref_id = l.ref_id
            and a.account_object_id is not distinct from l.account_object_id) x
        where abs(paid - coalesce(allocated, 0)) > 0.0001""",
        expected_pay_amount="coalesce(allocated, 0)", actual_pay_amount="paid",
    ),
    "ar5_allocation_without_link": _account_finding(
        "ALLOC_MISSING_LINK", VOUCHER_KEY,
        f"""{VOUCHER_CODE} || ';' || case when in_ledger then 'missing_source'
            when in_source then 'missing_ledger' else 'missing_ledger_and_source' end""",
        f"""from (
            select a.*, (select sum(l.pay_amount) from led_account_object_ledger l
                where l.ref_id = a.ref_id) as ledger_paid
            from ({_allocated('vendor_payment', '1021, 55051', 'ca_payment')}
            union all {_allocated('customer_receipt', '1011, 55041', 'ca_receipt')}) a
        ) x where not (in_ledger and in_source)""",
        expected_pay_amount="paid", actual_pay_amount="coalesce(ledger_paid, 0)",
    ),
}


# --- vouchers -------------------------------------------------------------------------------------

CANDIDATE = """source, order_id, payment_id, payment_type, receipt_ref_type,
    cast(receipt_amount as decimal(21,6)) as receipt_amount, receipt_is_cash_sale,
    cast(receipt_remain_amount as decimal(21,6)) as receipt_remain_amount, bank_account_id,
    account_number"""
GUEST = "account_object_id is null or account_object_id in ('', '" + codes.NO_ID + "')"
TARGET = "order_id, ref_no, ref_date, branch_id"


def _state(registry: str, intended: bool) -> str:
    missing = "s.value" if intended else "null"
    return f"""
    select s.branch_id, s.category_ref_type_id, s.prefix, s.length_of_value,
        cast(coalesce(h.highest, {missing}) as decimal(20,0)) as value,
        cast(h.highest as decimal(20,0)) as max_value,
        cast(null as boolean) as use_branch_prefix, cast(null as varchar) as branch_prefix,
        s.suffix
    from refno_state s left join (
        select branch_id, reftype_category,
            max(cast(regexp_extract(refno, '[0-9]+$') as hugeint)) as highest
        from ({registry}) r where regexp_matches(refno, '[0-9]+$') group by all) h
        on h.branch_id = s.branch_id and h.reftype_category = s.category_ref_type_id"""


OLD_NUMBERS = "select branch_id, reftype_category, refno from refno_management"
ALL_NUMBERS = f"{OLD_NUMBERS} union all select branch_id, reftype_category, refno from registry"


def _usage(times: int) -> str:
    kept = {
        "object_reference_id": "null",
        "primary_object_type": "o.primary_object_type",
        "primary_object_id": "o.primary_object_id",
        "reference_object_type": "o.reference_object_type",
        "used_count": "o.used_count + coalesce(u.used_count, 0)",
        "created_date": "null",
        "modified_date": f"case when u.used_count is not null then {NOW} end",
    }
    new = {
        "object_reference_id": _id(
            "'usage'", "primary_object_type", "primary_object_id", "reference_object_type"
        ),
        "used_count": f"u.used_count * {times}",
        "created_date": NOW,
        "modified_date": NOW,
    }
    same = """o.primary_object_type = u.primary_object_type
        and o.primary_object_id = u.primary_object_id
        and o.reference_object_type = u.reference_object_type"""
    schema = SCHEMAS["object_reference"]
    return f"""select {_project(schema, kept)} from object_reference o left join uses u on {same}
    union all
    select {_project(schema, new)} from uses u
    where not exists (select 1 from object_reference o where {same})"""


def _issue_select(total: str, join: str = "") -> str:
    values = {
        "ref_id": "i.ref_id",
        "employee_name": "'Tự động sinh'",
        "total_amount": total,
        "account_object_id": f"case when {GUEST} then '{codes.GUEST_ID}' else account_object_id end",
        "account_object_code": f"case when {GUEST} then 'Mã khách lẻ' else account_object_code end",
        "account_object_name": f"case when {GUEST} then 'Khách lẻ' else account_object_name end",
        "payment_type": "0",
        "attachment_list": "null",
        "created_date": NOW,
        "created_by": "null",
        "modified_date": NOW,
        "modified_by": f"'{codes.EDITOR}'",
        "employee_id": "null",
        "employee_code": "null",
        "object_type": "1",
    }
    return f"select {_project(SCHEMAS['outward'], values)} from issue i {join}"


def _totals(stage: str) -> str:
    return _issue_select(
        "coalesce(c.total, 0)",
        f"left join (select ref_id, sum(amount) as total from {stage} group by ref_id) c"
        " on c.ref_id = i.ref_id",
    )


def _line_values() -> dict[str, str]:
    empty = (
        "stock_location_id stock_location_name inward_ref_id inward_ref_detail_id created_by"
        " modified_by drug_code production_date registration_no drug_unit_id drug_quantity"
        " drug_price drug_unit_name"
    )
    return {
        **dict.fromkeys(empty.split(), "null"),
        "unit_price": "0",
        "amount": "0",
        "created_date": NOW,
        "modified_date": NOW,
        "inventory_item_type": "1",
    }


def _receipt_values() -> dict[str, str]:
    return {"is_auto_generate": "true", "approved_type": "3", **SIGNED["receipt"]}


def _receipt_line_values() -> dict[str, str]:
    return {
        "ref_detail_id": _id("'receipt line'", "ref_id"),
        "amount": "total_amount",
        "remain_amount": "receipt_remain_amount",
        "sort_order": "1",
        "budget_item_id": f"'{codes.BUDGET_ID}'",
        "budget_item_code": "'TTBH'",
        "budget_item_name": "'Thu từ bán hàng'",
        **SIGNED["receipt"],
    }


def _count(table: str, text: str, money: str | None = None, column: bool = True) -> str:
    amount = f"sum({money})" if money else "null"
    amount = f", cast({amount} as decimal(38,6)) as amount" if column else ""
    return f"select '{table}' as table_name, count(*) as rows_written{amount} from ({text}) q"


VOUCHERS = {
    "vg1_target_orders": f"select {TARGET} from target_rows",
    "vg2_oldest_batch": f"""select {TARGET} from target_rows
        order by ref_date nulls first, order_id limit {BATCH}""",
    "vg3_sale_receipts": f"select {CANDIDATE} from candidates where source = 1",
    "vg4_cod_receipts": f"select {CANDIDATE} from candidates where source = 2",
    "vg4_cod_receipts_intended": f"select {CANDIDATE} from candidates_once where source = 2",
    "vg5_debt_receipts": f"select {CANDIDATE} from candidates where source = 3",
    "vg5_debt_receipts_intended": f"select {CANDIDATE} from candidates_once where source = 3",
    "vg6_customer_debt": """select account_object_id, branch_id,
        max(separate_debt_amount) as separate_debt_amount
        from led_account_object_closing group by account_object_id, branch_id""",
    "vg7_receipt_candidates": f"select {CANDIDATE} from candidates",
    "vg8_receipt_sequence": """select order_id, payment_id, receipt_ref_type, branch_id, row_num
        from numbered""",
    "vg8_receipt_sequence_intended": """select order_id, payment_id, receipt_ref_type, branch_id,
        row_num from numbered_in_branch""",
    "vg8_issue_sequence": "select order_id, branch_id, row_num from issue_numbered",
    "vg8_issue_sequence_intended": f"""select order_id, branch_id,
        {_sequence(ISSUE_ORDER, True)} as row_num from target_rows""",
    "vg9_voucher_numbers": """
        select branch_id, category_ref_type_id, order_id, ref_id, ref_no from receipt
        union all select branch_id, category_ref_type_id, order_id, ref_id, ref_no from issue""",
    "vg9_voucher_numbers_intended": f"""
        select n.branch_id, s.category_ref_type_id, n.order_id, n.row_num, {NUMBER_KEPT} as ref_no
        from numbered_in_branch n {STATE.format(codes.RECEIPT_CATEGORY)}
        union all
        select n.branch_id, s.category_ref_type_id, n.order_id, n.row_num, {NUMBER_KEPT} as ref_no
        from (select *, {_sequence(ISSUE_ORDER, True)} as row_num from target_rows) n
        {STATE.format(codes.ISSUE_CATEGORY)}""",
    "vg9_numbers_too_long": f"""
        select n.branch_id, s.category_ref_type_id, count(*) as numbers
        from (select branch_id, row_num, {codes.RECEIPT_CATEGORY} as category from numbered
            union all select branch_id, row_num, {codes.ISSUE_CATEGORY} from issue_numbered) n
        join refno_state s on s.branch_id = n.branch_id and s.category_ref_type_id = n.category
        where length(cast(coalesce(s.value, 0) + n.row_num as varchar)) > s.length_of_value
        group by all""",
    "vg10_receipt_headers": f"""
        select {_project(SCHEMAS['ca_receipt'], _receipt_values())} from receipt""",
    "vg11_receipt_lines": f"""
        select {_project(SCHEMAS['ca_receipt_detail'], _receipt_line_values())} from receipt""",
    "vg12_receipt_usage": "select * from receipt_use",
    "vg13_order_links": "select * from link",
    "vg14_number_registry": "select * from registry",
    "vg15_number_state": _state(ALL_NUMBERS, False),
    "vg15_number_state_before_run": _state(OLD_NUMBERS, False),
    "vg15_number_state_before_run_intended": _state(OLD_NUMBERS, True),
    "vg16_usage_counters": _usage(2),
    "vg16_usage_counters_intended": _usage(1),
    "vg17_issue_headers": _issue_select("0"),
    "vg18_issue_lines": f"""
        select {_project(SCHEMAS['outward_detail'], _line_values())} from issue_line""",
    "vg19_stock_on_hand": "select * from on_hand",
    "vg19_stock_on_hand_intended": "select * from on_hand_asof",
    "vg19_stock_on_hand_clustered": "select * from on_hand",
    "vg19_stock_on_hand_clustered_intended": "select * from on_hand_asof",
    "vg20_costed_lines": "select * from costed",
    "vg20_costed_lines_intended": "select * from costed_asof",
    "vg21_issue_totals": _totals("costed"),
    "vg21_issue_totals_intended": _totals("costed_asof"),
    "vg22_issue_usage": "select * from issue_use",
    "vg23_orders_to_refresh": "select distinct order_id as ref_id2 from receipt",
    "vg_orders_without_state": """select branch_id, c.category as category_ref_type_id,
        count(*) as orders from target_rows t cross join (values (1010), (2091)) c(category)
        where not exists (select 1 from refno_state s
            where s.branch_id = t.branch_id and s.category_ref_type_id = c.category)
        group by branch_id, c.category""",
    "vg_unit_conflicts": """select inventory_item_id, unit_id, count(*) as rates
        from unit_convert group by all having count(*) > 1""",
    "vg_whole_run": " union all ".join(
        [
            _count("ca_receipt", "select total_amount from receipt", "total_amount"),
            _count("ca_receipt_detail", "select total_amount from receipt", "total_amount"),
            _count("outward", _totals("costed"), "total_amount"),
            _count("outward_detail", "select amount from costed", "amount"),
            _count("voucher_reference", "select * from link"),
            _count("refno_management", "select * from registry"),
            _count("refno_state", "select * from refno_state"),
            _count("object_reference", _usage(2), "used_count"),
        ]
    ),
}


# --- synchronisation -----------------------------------------------------------------------------

CHANNEL = """case channel_id when 90 then 'Cửa hàng' when 20 then 'Shopee'
    when 70 then 'TikTok Shop' when 5 then 'Facebook' else '' end"""


def _order_values() -> dict[str, str]:
    return {
        **sync.ORDER_SOURCES,
        **dict.fromkeys(sync.ORDER_EMPTY, "null"),
        "order_id": "o.order_id",
        "ref_id": "o.order_id",
        "payment_method": "v.payment_type",
        "channel_name": CHANNEL,
        "partner_order_status": "''",
        "created_date": NOW,
        "created_by": "'sync script'",
        "priority": "20",
        "publish_status": "0",
        "einvoice_id": _id("'einvoice'", "o.order_id", "v.payment_type"),
        "is_apply_tax": "coalesce(is_apply_tax, false)",
        "is_send_message": "false",
        "is_only_return": "false",
        "is_mapped_stock": "false",
        "is_mapped_product": "false",
        "invoice_type": "0",
    }


def _line_copy_values() -> dict[str, str]:
    return {
        **sync.LINE_SOURCES,
        **dict.fromkeys(sync.LINE_EMPTY, "null"),
        "order_id": "x.order_id",
        "stock_id": f"coalesce(o.stock_id, '{codes.NO_ID}')",
        "stock_name": "coalesce(o.stock_name, '')",
        "discount_amount_before_tax": "x.discount_amount_before_tax",
        "ta_career_group_int_id": "x.ta_career_group_int_id",
        "personal_tax_rate": "x.personal_tax_rate",
        "tax_amount": "x.tax_amount",
        "tax_reduction_amount": "x.tax_reduction_amount",
        "is_tax_reduction": "x.is_tax_reduction",
        "created_date": NOW,
        "created_by": "''",
        "modified_date": NOW,
        "modified_by": "''",
        "allocation_used_point": "coalesce(allocation_used_point, 0)",
    }


MISSING_ORDERS = f"""select {_project(sync.GENERAL_ORDER, _order_values())}
    from sa_order o left join view_sa_order_payment v on v.order_id = o.order_id
    where o.order_id not in (select order_id from general_order)"""
MISSING_LINES = f"""
    select {_project(sync.GENERAL_ORDER_DETAIL, _line_copy_values())}
    from sa_order_detail x join sa_order o on o.order_id = x.order_id
    where x.order_detail_id not in (select order_detail_id from general_order_detail
        where order_id is not null)"""
DIFFERS = "(g.ref_no <> o.ref_no or g.order_status <> o.order_status)"
UPDATES = {name: f"o.{source}" for name, source in sync.UPDATED.items()}


def _updated_orders() -> str:
    stored = {"order_id", "ref_no", "order_status"}
    values = {name: f"g.{name}" if name in stored else "null" for name in sync.GENERAL_ORDER}
    for name, value in {**UPDATES, "modified_by": f"'{codes.EDITOR}'"}.items():
        old = f"g.{name}" if name in stored else "null"
        values[name] = f"case when {DIFFERS} then {value} else {old} end"
    return f"""select {_project(sync.GENERAL_ORDER, values)}
    from general_order g left join sa_order o on o.order_id = g.order_id
    union all {MISSING_ORDERS}"""


CANCELLED = "select order_id from sa_order where order_status = 90"
CANCELLED_LINKS = f"select * from voucher_reference where ref_id2 in ({CANCELLED})"
CANCELLED_VOUCHERS = f"select ref_id1 from voucher_reference where ref_id2 in ({CANCELLED})"
SYNC = {
    "sy1_missing_orders": MISSING_ORDERS,
    "sy2_channel_names": f"select order_id, {CHANNEL} as channel_name from sa_order",
    "sy3_missing_order_lines": MISSING_LINES,
    "sy4_changed_orders": f"""
        select g.order_id, {', '.join(f'{value} as {name}' for name, value in UPDATES.items())},
            '{codes.EDITOR}' as modified_by
        from general_order g join sa_order o on o.order_id = g.order_id where {DIFFERS}""",
    "sy4_next_orders": _updated_orders(),
    "sy5_issues_to_delete": f"""select ref_id, ref_type from outward
        where ref_id in ({CANCELLED_VOUCHERS})""",
    "sy6_receipts_to_delete": f"""select ref_id from ca_receipt
        where ref_id in ({CANCELLED_VOUCHERS})""",
    "sy7_links_to_delete": f"""select reference_id, ref_id1, ref_id2, ref_type1
        from ({CANCELLED_LINKS}) q""",
    "sy_whole_run": " union all ".join(
        _count(table, text, column=False)
        for table, text in {
            "general_order_detail": MISSING_LINES,
            "general_order": _updated_orders(),
            "outward": f"""select ref_id from outward
                where ref_id not in ({CANCELLED_VOUCHERS})""",
            "ca_receipt": f"""select ref_id from ca_receipt
                where ref_id not in ({CANCELLED_VOUCHERS})""",
            "voucher_reference": f"""select reference_id from voucher_reference
                where ref_id2 not in ({CANCELLED})""",
        }.items()
    ),
}


def _capped() -> str:
    parts = [
        f"(select * from ({text}) q order by business_key limit {CAP + 1})"
        for text in RECEIVABLE.values()
    ]
    return " union all ".join(parts)


def _cuts() -> str:
    return " union all ".join(
        f"""select '{name.split('_')[0].upper()}' as check_id, count(*) as findings,
        count(*) > {CAP} as truncated from ({text}) q"""
        for name, text in RECEIVABLE.items()
    )


def oracle_sql() -> dict[str, str]:
    texts = {
        **_inventory(True),
        "inv7_ledger_vs_balance_clustered": _inventory(True)["inv7_ledger_vs_balance"],
        "inv_all_stock_report": " union all ".join(_inventory(False).values()),
        **RECEIVABLE,
        "ar_cap_capped_findings": _capped(),
        "ar_cap_cut_summary": _cuts(),
        "ar_all_account_report": " union all ".join(RECEIVABLE.values()),
        **VOUCHERS,
        **SYNC,
    }
    return {name: _complete(text) for name, text in texts.items()}
