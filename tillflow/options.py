"""Switches of the business rules. The defaults give the published numbers."""

from __future__ import annotations

from dataclasses import dataclass, field

# Customer classes and texts that occur in the data.
WALK_IN = "Khách lẻ"
NEW_GUEST = "Khách mới"
RETURNING_GUEST = "Khách quay lại"
DEFAULT_TIER = "Thành viên mặc định"
NO_TOPPING = "Không lấy Topping"
OTHER_STORE = "Khác"
UNKNOWN_STORE = "Chi nhánh là"

# Log types.
CHANGE = "SALE_CHANGE"
MERGE = "SALE_MERGE_ORDER"
SPLIT = "SALE_SPLIT_ORDER"
LOG_TYPES = (MERGE, CHANGE, SPLIT, "-")

# Store codes looked for anywhere in an invoice number, in this order.
STORE_CODES_ANYWHERE = (
    ("CVGTN", "Chạng Vạng Trần Não"),
    ("CVGHX", "Chạng Vạng Hàng Xanh"),
    ("TN", "Trăng Non"),
    ("THU", "Thương"),
    ("CHV", "Chênh Vênh"),
)
STORE_CODE_OR_NO_NUMBER = ("RC", "Ráng Chiều")

# Store codes an invoice number may start with.
STORE_CODES_AT_START = (
    ("THU", "Thương"),
    ("CVGTN", "Chạng Vạng Trần Não"),
    ("CVGHX", "Chạng Vạng Hàng Xanh"),
    ("CHV", "Chênh Vênh"),
    ("RC", "Ráng Chiều"),
)

TIME_ZONE = "Asia/Ho_Chi_Minh"


@dataclass(frozen=True)
class GroupLimits:
    """A group with more than ``max_rows`` rows is cut into blocks of about that many."""

    max_rows: int = 1_000_000


@dataclass(frozen=True)
class Options:
    """Business switches; see the README for what each one changes."""

    include_merge_only: bool = False
    reprice_after_netting: bool = False
    # The rate looks for two texts; the first is not a class that is ever assigned.
    identified_classes: tuple[str, ...] = ("Khách hàng mới", RETURNING_GUEST)
    keep_null_phone: bool = False
    pair_rates: bool = True
    zero_fill_text: bool = False
    day_opens_at_hour: int = 0
    limits: GroupLimits = field(default_factory=GroupLimits)
