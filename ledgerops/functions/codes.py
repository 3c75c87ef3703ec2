"""Code numbers and texts that the retail tables agree on."""

from __future__ import annotations

# order
ORDER_DONE = (80, 85)
ORDER_CANCELLED = 90
ORDER_OPEN_ABOVE, ORDER_OPEN_BELOW = 5, 50
SALES_ORDER = 549
CHANNEL_STORE = 90
CHANNEL_NAMES = {90: "Cửa hàng", 20: "Shopee", 70: "TikTok Shop", 5: "Facebook"}

# vouchers
STOCK_ISSUE = 2900
CASH_SALE, BANK_SALE, BANK_DEPOSIT = 1012, 55042, 55044
CASH_DEBT, BANK_DEBT = 1011, 55041
RECEIPT_LINKS = (CASH_SALE, BANK_SALE, BANK_DEPOSIT)
COD_LINKS = (55200, 55210, BANK_SALE, CASH_SALE)
DEBT_LINKS = (CASH_DEBT, BANK_DEBT)
VENDOR_PAYMENT = (1021, 55051)
CUSTOMER_RECEIPT = (1011, 55041)
ALLOCATED = (1021, 55051, 304, 1011, 55041, 5513)
TWO_WAY_TRANSFER = (2909, 2910)

# payment types
CASH_PAYMENT = (5, 18, 20, 21)
CASH_DEBT_PAYMENT = 15
DEPOSIT_PAYMENT = 16
DEBT_PAYMENT = (11, 12, 13, 15)
NOT_A_SALE_PAYMENT = (7, 8, 11, 12, 13, 15)
UNRECONCILED_PAYMENT = (2, 3, 12, 13)

# numbering and usage
RECEIPT_CATEGORY, ISSUE_CATEGORY = 1010, 2091
STORE_OPTION = "StoreRefNo"
USED_CUSTOMER, USED_BANK_ACCOUNT, USED_EMPLOYEE = 115, 113, 2
USED_ITEM, USED_STOCK, USED_LOCATION = 100, 104, 105

# items
STOCKED_ITEM = 1

# masters
NO_ID = "00000000-0000-0000-0000-000000000000"
GUEST_ID = "c560be89-d30b-11ef-b6d5-005056b332bc"
GUEST_CODE, GUEST_NAME = "Mã khách lẻ", "Khách lẻ"
BUDGET_ID = "0d321ffd-14fa-11f0-9deb-005056b332bc"
BUDGET_CODE, BUDGET_NAME = "TTBH", "Thu từ bán hàng"
APPROVED = 3
RECEIPT_AUTHOR, EDITOR, SYNC_AUTHOR = "script", "MISA_SP", "sync script"

# texts
DEBT_MEMO = "Thu tiền bán hàng từ "
DEPOSIT_MEMO = "Thu đặt cọc/trả trước đơn hàng "
SALE_MEMO = "Thu tiền bán hàng đơn hàng "
ISSUE_MEMO = "Xuất kho bán hàng theo đơn hàng số "
ISSUE_EMPLOYEE = "Tự động sinh"
