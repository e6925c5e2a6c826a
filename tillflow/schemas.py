"""Schemas of the landed snapshots and the column headings of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def columns(text: str) -> T.StructType:
    """``name type, name type`` as a schema, without needing a session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in text.split(","))])


# The fields of the till's feeds.
INVOICE = columns(
    "_store_uid string, tran_id string, origin_tran_id string, tran_no string, created_at timestamp, "
    "start_hour int, start_minute int, end_hour int, end_minute int, table_name string, "
    "discount_extra_amount double, amount_discount_detail double, extra_data string, total_amount double"
)
INVOICE_LINE = columns(
    "tran_id string, tran_no string, table_name string, store_uid string, peo_count int, item_name string, "
    "item_type_name string, quantity double, price double, unit_id string, amount_origin double, store_name string"
)
ORDER_LOG = columns("created_at string, tran_id string, log_type string, table_name string, change_data string")
REMOVED_ITEM = columns(
    "tran_id string, tran_no string, employee_name string, table_name string, _store_uid string, "
    "updated_at string, sale_detail string"
)

# Columns that say where in the feed a row stood; written at ingest.
PROVENANCE = columns("_date string, seq bigint")

RECORDS = {
    "invoice": INVOICE,
    "invoice_line": INVOICE_LINE,
    "order_log": ORDER_LOG,
    "removed_item": REMOVED_ITEM,
}

# Columns each job reads.
STAFF_INVOICE = (
    "_store_uid", "tran_id", "origin_tran_id", "tran_no", "created_at", "start_hour", "start_minute", "end_hour",
    "end_minute", "table_name", "discount_extra_amount", "extra_data", "total_amount",
)
DAILY_INVOICE = (
    "_store_uid", "tran_id", "origin_tran_id", "tran_no", "created_at", "start_hour", "start_minute", "end_hour",
    "end_minute", "table_name", "amount_discount_detail", "extra_data", "total_amount",
)

# Headings of the published tables, in column order.
_CALENDAR = {"date": "Ngày", "week": "Tuần", "month": "Tháng", "year": "Năm"}
HEADINGS = {
    "sales_lines": _CALENDAR
    | {
        "store": "Cửa hàng", "number": "Số hoá đơn", "customer_class": "Loại khách hàng", "item": "Món",
        "price": "Đơn giá", "employee": "Nhân viên", "table": "Bàn", "log_type": "Loại log",
        "qty": "Số lượng order", "guests": "Số khách", "time": "Thời gian", "revenue": "Giá trị order",
        "phone": "SĐT",
    },
    "cancellations": _CALENDAR
    | {
        "store": "Cửa hàng", "number": "Số hoá đơn", "employee": "Nhân viên", "item": "Món", "qty": "Số lượng",
        "reason": "Lý do", "time": "Thời gian",
    },
    "staff_order": _CALENDAR
    | {
        "store": "Cửa hàng", "number": "Số hoá đơn", "guests": "Số khách", "customer_class": "Loại khách hàng",
        "employee": "Nhân viên", "phone": "SĐT", "revenue": "Giá trị order", "cancel_count": "Số lần hủy món",
        "cancel_qty": "Số lượng hủy món",
    },
    "staff_kpi": _CALENDAR
    | {
        "store": "Cửa hàng", "employee": "Nhân viên", "revenue": "Tổng giá trị order",
        "cancel_count": "Tổng số lần hủy món", "cancel_qty": "Tổng số lượng hủy món", "guests": "Tổng số khách",
        "revenue_per_guest": "Doanh thu trên KH", "identified_rate": "% xin thông tin KH",
        "store_day_revenue": "Tổng giá trị order trong ngày", "staff_invoices": "Tổng hoá đơn theo nhân viên",
        "store_day_invoices": "Tổng hoá đơn trong ngày",
    },
    "customer_invoice": _CALENDAR
    | {
        "number": "Số hoá đơn", "time": "Thời gian", "store": "Cửa hàng", "total": "Tổng hóa đơn",
        "time_in": "Giờ vào", "time_out": "Giờ ra", "table": "Bàn", "guests": "Số khách", "discount": "Giảm giá",
        "tier": "Loại thành viên", "name": "Tên Khách", "phone": "SĐT", "customer_class": "Customer Type",
    },
    "daily_invoice": {
        "month_year": "Month-Year", "week_year": "Week-Year", "hour_in": "Hour_in", "hour_out": "Hour_out",
        "store": "Cửa hàng", "number": "Số hóa đơn", "date": "Ngày", "time_in": "Giờ vào", "time_out": "Giờ ra",
        "table": "Bàn", "area": "Khu vực", "guests": "Số khách", "gross": "Gross Revenue", "discount": "Giảm giá",
        "net": "Net Revenue", "tier": "Loại thành viên", "name": "Tên", "phone": "SĐT",
        "hours_used": "Thời gian sử dụng (giờ)",
    },
}

# Row order of the published tables; a leading minus means largest first.
SORTED_BY = {
    "sales_lines": ("number", "item", "time"),
    "staff_order": ("date", "number", "employee"),
    "staff_kpi": ("date", "-revenue"),
    "customer_invoice": ("number", "time"),
    "daily_invoice": ("date", "time_in"),
}
