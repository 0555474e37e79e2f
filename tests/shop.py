"""A small shop with the edge cases regular data lacks."""

from basketry.plans.staging import stage_all
from basketry.relations import Relations
from basketry.sources import RawTables

T0 = "2024-03-01"

USERS = [
    ("1", "Ann@Mail.com", "1/15/2024", "usa", "Premium", T0),
    ("2", "BOB@mail.com", "2024-02-03", "uk", "Basic", T0),
    ("3", "cy@mail.com", "12/1/2023", "uk", None, T0),
    ("4", "di@mail.com", "2024-01-01", "usa", "Basic", T0),  # never ordered
]
PRODUCTS = [
    ("10", "Lamp", "home", "7", "4.00", T0),
    ("11", "Desk", "office", "7", "50.00", T0),
    ("12", "Chair", "office", "8", "20.00", T0),
    ("13", "Vase", "home", "8", "2.50", T0),  # never sold
]
ORDERS = [
    ("100", "1", "2024-01-02", "Completed", "140.00", T0),
    ("101", "1", "2024-01-20", "completed", "30.00", T0),
    ("102", "2", "2024-01-20", "CANCELLED", "0.00", T0),
    ("103", "2", "2024-02-10", "completed", "600.00", T0),
    ("104", "9", "2024-02-11", "completed", "10.00", T0),  # unknown user
    ("105", "3", "2024-02-12", None, "5.00", T0),  # no status
    ("106", "3", "2024-02-13", "completed", "0.00", T0),  # no lines
]
ITEMS = [
    ("1000", "100", "10", "2", "10.00", T0),
    ("1001", "100", "11", "2", "60.00", T0),  # same quantity, larger sales
    ("1002", "101", "12", "1", "15.00", T0),  # full tie with the next line:
    ("1003", "101", "11", "1", "15.00", T0),  # the lower product id wins
    ("1004", "103", "11", "6", "60.00", T0),
    ("1005", "103", "11", "4", "60.00", T0),  # same product twice
    ("1006", "104", "12", "1", "10.00", T0),
    ("1007", "105", "99", "1", "5.00", T0),  # unknown product only
]
RETURNS = [
    ("5000", "1001", "2024-02-20", "Defective", "60.00", T0),  # 49 days after the order
    ("5001", "1001", "2024-02-21", "changed_mind", "70.00", T0),  # second return of the line
    ("5002", "1006", "2024-02-12", "wrong_item", "12.00", T0),  # above the line's sales
]


def raw(spark) -> RawTables:
    from basketry.sources import RAW_COLUMNS

    def frame(name, data):
        schema = ", ".join(f"{c} string" for c in RAW_COLUMNS[name])
        return spark.createDataFrame(data, schema)

    return RawTables(
        users=lambda: frame("users", USERS),
        products=lambda: frame("products", PRODUCTS),
        orders=lambda: frame("orders", ORDERS),
        order_items=lambda: frame("order_items", ITEMS),
        returns=lambda: frame("returns", RETURNS),
    )


def staged(spark) -> Relations:
    return stage_all(raw(spark))
