"""Synthetic shop data, computed per row from a hash of (seed, row, column).

Rows come from a DataFrame with a 0-based ``i`` (``row_ids`` or the keys of a
real table); foreign keys point at ``CUST000001`` … by modulo, so every table
is generated on its own and still fits the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The generator's pools.
FIRST_NAMES = """John Jane Michael Sarah David Emily James Emma Robert Lisa William Jennifer Thomas Maria Christopher
Michelle Daniel Jessica Matthew Ashley Anthony Amanda Mark Melissa Steven Deborah Paul Stephanie Andrew Dorothy
Kenneth Amy Joshua Angela Kevin Helen Brian Brenda George Julie Edward Joyce Ronald Virginia Timothy Victoria Jason
Kelly Jeffrey Christina""".split()
LAST_NAMES = """Smith Johnson Williams Brown Jones Garcia Miller Davis Rodriguez Martinez Hernandez Lopez Gonzalez
Wilson Anderson Thomas Taylor Moore Jackson Martin Lee Perez Thompson White Harris Sanchez Clark Ramirez Lewis
Robinson Walker Young Allen King Wright Scott Torres Nguyen Hill Flores Green Adams Nelson Baker Hall Rivera
Campbell Mitchell Carter Roberts""".split()
COUNTRIES = ["USA", "Canada", "UK", "Germany", "France", "Spain", "Italy", "Australia", "Japan", "South Korea",
             "China", "India", "Brazil", "Mexico", "Netherlands", "Sweden", "Norway", "Denmark", "Finland"]
CITIES = {
    "USA": ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia"],
    "Canada": ["Toronto", "Vancouver", "Montreal", "Calgary", "Ottawa", "Edmonton"],
    "UK": ["London", "Manchester", "Birmingham", "Liverpool", "Leeds", "Sheffield"],
    "Germany": ["Berlin", "Hamburg", "Munich", "Cologne", "Frankfurt", "Stuttgart"],
    "France": ["Paris", "Marseille", "Lyon", "Toulouse", "Nice", "Nantes"],
    "Australia": ["Sydney", "Melbourne", "Brisbane", "Perth", "Adelaide", "Canberra"],
    "Japan": ["Tokyo", "Osaka", "Kyoto", "Yokohama", "Kobe", "Nagoya"],
}
AGE_GROUPS = ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
CATEGORIES = ["Electronics", "Fashion", "Home", "Sports", "Books", "Automotive", "Health", "Beauty", "Garden", "Toys",
              "Jewelry", "Music"]
PRODUCT_NAMES = {
    "Electronics": ["Smartphone", "Laptop", "Tablet", "Headphones", "Speaker", "Camera", "TV", "Gaming Console"],
    "Fashion": ["T-Shirt", "Jeans", "Dress", "Shoes", "Jacket", "Hat", "Watch", "Sunglasses"],
    "Home": ["Coffee Maker", "Blender", "Vacuum", "Lamp", "Chair", "Table", "Bed", "Sofa"],
    "Sports": ["Running Shoes", "Yoga Mat", "Bicycle", "Tennis Racket", "Soccer Ball", "Dumbbells"],
}
SUBCATEGORIES = {
    "Electronics": ["Audio", "Video", "Computer", "Mobile", "Gaming"],
    "Fashion": ["Clothing", "Footwear", "Accessories", "Jewelry"],
    "Home": ["Kitchen", "Furniture", "Decor", "Appliances"],
    "Sports": ["Fitness", "Outdoor", "Team Sports", "Water Sports"],
}
BRANDS = ["TechBrand", "SportMax", "HomeEssentials", "FashionForward", "GadgetPro", "StyleMaster", "ComfortZone",
          "PowerGear", "UrbanStyle", "PremiumChoice"]
ORDER_STATUSES = ["completed", "processing", "shipped", "cancelled", "pending"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "bank_transfer", "cash"]
STREETS = ["Main St", "Oak Ave", "Pine Rd", "First St", "Second Ave", "Park Blvd"]
TRAFFIC_SOURCES = ["google", "facebook", "direct", "email", "twitter", "linkedin", "youtube", "bing"]
DEVICES = ["desktop", "mobile", "tablet"]
BROWSERS = ["chrome", "firefox", "safari", "edge", "opera"]
PAGE_URLS = ["/home", "/products", "/about", "/contact", "/cart", "/checkout", "/search", "/category/electronics",
             "/category/fashion", "/category/home", "/product/detail", "/user/profile", "/user/orders", "/blog", "/support"]
PAGE_TITLES = ["Home Page", "Product Catalog", "About Us", "Contact Us", "Shopping Cart", "Checkout", "Search Results",
               "User Profile", "Order History", "Product Details", "Category Page", "Blog Post"]
REFERRERS = ["https://google.com", "https://facebook.com", "https://twitter.com", "direct", "https://linkedin.com",
             "https://youtube.com", "email", "https://bing.com", "https://reddit.com"]
EVENT_TYPES = ["click", "scroll", "hover", "form_fill", "search", "download", "video_play"]
ELEMENT_TYPES = ["button", "link", "input", "image", "video"]


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "i")


def draw(seed: int, column: str, below: int | Column) -> Column:
    """Whole number in [0, below), fixed by seed, row and column name."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("i").cast("string"), F.lit(column)))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return number % (F.lit(below) if isinstance(below, int) else below)


def between(seed: int, column: str, low: int, high: int) -> Column:
    """Whole number from ``low`` to ``high``, both included."""
    return draw(seed, column, high - low + 1) + low


def cents(seed: int, column: str, low: int, high: int) -> Column:
    """Decimal amount from ``low`` to ``high`` in steps of 0.01."""
    return (between(seed, column, low * 100, high * 100) * F.expr("0.01BD")).cast("decimal(12,2)")


def pick(seed: int, column: str, pool: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in pool]), (draw(seed, column, len(pool)) + 1).cast("int"))


def pick_by(seed: int, column: str, key: str, pools: dict[str, list[str]], default: str) -> Column:
    """Choice from the pool that belongs to the value of column ``key``."""
    out = F.lit(default)
    for value, pool in pools.items():
        out = F.when(F.col(key) == value, pick(seed, column, pool)).otherwise(out)
    return out


def ident(prefix: str, number: Column, width: int = 6) -> Column:
    return F.concat(F.lit(prefix), F.lpad((number + 1).cast("string"), F.greatest(F.lit(width), F.length((number + 1).cast("string"))), F.lit("0")))


def moment(seed: int, column: str, start: str, end: str) -> Column:
    """Random second from ``start`` up to, but not including, ``end``."""
    first = F.lit(start).cast("date")
    day = F.date_add(first, (draw(seed, column + "_day", F.datediff(F.lit(end).cast("date"), first))).cast("int"))
    at = F.unix_seconds(day.cast("timestamp")) + draw(seed, column + "_second", 86400)
    return F.timestamp_seconds(at).cast("timestamp_ntz")


def gen_customers(ids: DataFrame, seed: int = 1, start: str = "2020-01-01", end: str = "2024-12-31") -> DataFrame:
    three, four = lambda c, lo: between(seed, c, lo, 999).cast("string"), lambda c: between(seed, c, 1000, 9999).cast("string")
    dash = F.lit("-")
    phone = (
        F.when(F.col("country") == "USA", F.concat(F.lit("+1-"), three("p1", 200), dash, three("p2", 200), dash, four("p3")))
        .when(F.col("country") == "UK", F.concat(F.lit("+44-20-"), four("p1"), dash, four("p2")))
        .when(F.col("country") == "Germany", F.concat(F.lit("+49-30-"), three("p1", 100), dash, four("p2")))
        .otherwise(F.concat(F.lit("+"), three("p1", 1), dash, three("p2", 100), dash, four("p3")))
    )
    named = ids.select("i", ident("CUST", F.col("i")).alias("customer_id"), pick(seed, "first", FIRST_NAMES).alias("first_name"),
                       pick(seed, "last", LAST_NAMES).alias("last_name"), pick(seed, "country", COUNTRIES).alias("country"))
    return named.select(
        "customer_id", "first_name", "last_name",
        F.concat(F.lower("first_name"), F.lit("."), F.lower("last_name"), F.lit("@email.com")).alias("email"),
        phone.alias("phone"), moment(seed, "registered", start, end).alias("registration_date"), "country",
        pick_by(seed, "city", "country", CITIES, "Unknown City").alias("city"), pick(seed, "age", AGE_GROUPS).alias("age_group"),
    )


def gen_products(ids: DataFrame, seed: int = 1, start: str = "2020-01-01", end: str = "2024-06-30") -> DataFrame:
    base = ids.select("i", pick(seed, "category", CATEGORIES).alias("category"), cents(seed, "cost", 10, 500).alias("cost"))
    markup = between(seed, "markup", 150, 300) * F.expr("0.01BD")
    return base.select(
        ident("PROD", F.col("i")).alias("product_id"),
        F.concat(pick(seed, "label", BRANDS), F.lit(" "),
                 pick_by(seed, "name", "category", PRODUCT_NAMES, "Generic Product")).alias("product_name"),
        "category", pick_by(seed, "sub", "category", SUBCATEGORIES, "General").alias("sub_category"),
        pick(seed, "brand", BRANDS).alias("brand"),
        F.round(F.col("cost") * markup.cast("decimal(4,2)"), 2).cast("double").alias("price"), F.col("cost").cast("double").alias("cost"),
        ident("SUP", draw(seed, "supplier", 20), 3).alias("supplier_id"), moment(seed, "launch", start, end).alias("launch_date"),
    )


def gen_orders(ids: DataFrame, customers: int | Column, seed: int = 1, start: str = "2024-01-01", end: str = "2024-06-30") -> DataFrame:
    amount, shipping = cents(seed, "amount", 25, 500), cents(seed, "shipping", 5, 25)
    return ids.select(
        ident("ORD", F.col("i")).alias("order_id"), ident("CUST", draw(seed, "customer", customers)).alias("customer_id"),
        moment(seed, "ordered", start, end).alias("order_date"), pick(seed, "status", ORDER_STATUSES).alias("order_status"),
        amount.cast("double").alias("total_amount"),
        F.when(amount > 100, 0.0).otherwise(shipping.cast("double")).alias("shipping_cost"),
        pick(seed, "payment", PAYMENT_METHODS).alias("payment_method"),
        F.concat(between(seed, "house", 1, 9999).cast("string"), F.lit(" "), pick(seed, "street", STREETS)).alias("shipping_address"),
    )


def gen_order_items(ids: DataFrame, orders: int | Column, products: int | Column, seed: int = 1) -> DataFrame:
    unit, qty = cents(seed, "unit", 10, 200), between(seed, "quantity", 1, 5)
    share = (between(seed, "discount", 5, 25) * F.expr("0.01BD")).cast("decimal(4,2)")
    discount = F.when(draw(seed, "discounted", 100) < 30, F.round(unit * share, 2)).otherwise(F.lit(0).cast("decimal(12,2)"))
    return ids.select(
        ident("ITEM", F.col("i")).alias("order_item_id"), ident("ORD", draw(seed, "order", orders)).alias("order_id"),
        ident("PROD", draw(seed, "product", products)).alias("product_id"), qty.alias("quantity"),
        unit.cast("double").alias("unit_price"), discount.cast("double").alias("discount_amount"),
        (unit * qty - discount).cast("double").alias("line_total"),
    )


def gen_web_sessions(ids: DataFrame, users: int | Column, seed: int = 1, start: str = "2024-01-01", end: str = "2024-06-30") -> DataFrame:
    base = ids.select("i", moment(seed, "session", start, end).alias("session_start"),
                      between(seed, "duration", 30, 3600).alias("session_duration_seconds"))
    return base.select(
        ident("SES", F.col("i")).alias("session_id"), ident("USR", draw(seed, "user", users)).alias("user_id"), "session_start",
        (F.col("session_start") + F.make_dt_interval(secs=F.col("session_duration_seconds"))).alias("session_end"),
        between(seed, "pages", 1, 25).alias("page_views"), "session_duration_seconds",
        pick(seed, "source", TRAFFIC_SOURCES).alias("traffic_source"), pick(seed, "device", DEVICES).alias("device_type"),
        pick(seed, "browser", BROWSERS).alias("browser"), pick(seed, "country", COUNTRIES).alias("country"),
    )


def gen_page_views(ids: DataFrame, sessions: int | Column, users: int | Column, seed: int = 1,
                   start: str = "2024-01-01", end: str = "2024-06-30") -> DataFrame:
    return ids.select(
        ident("PV", F.col("i")).alias("page_view_id"), ident("SES", draw(seed, "session", sessions)).alias("session_id"),
        ident("USR", draw(seed, "user", users)).alias("user_id"), pick(seed, "url", PAGE_URLS).alias("page_url"),
        pick(seed, "title", PAGE_TITLES).alias("page_title"), moment(seed, "viewed", start, end).alias("timestamp"),
        between(seed, "stay", 5, 600).alias("time_on_page_seconds"), pick(seed, "referrer", REFERRERS).alias("referrer_url"),
        (draw(seed, "exit", 2) == 1).alias("exit_page"),
    )


def gen_user_events(ids: DataFrame, sessions: int | Column, users: int | Column, seed: int = 1,
                    start: str = "2024-01-01", end: str = "2024-06-30") -> DataFrame:
    numbered = lambda text, c, n: F.concat(F.lit(text), between(seed, c, 1, n).cast("string"))
    return ids.select(
        ident("EVT", F.col("i")).alias("event_id"), ident("SES", draw(seed, "session", sessions)).alias("session_id"),
        ident("USR", draw(seed, "user", users)).alias("user_id"), pick(seed, "type", EVENT_TYPES).alias("event_type"),
        moment(seed, "happened", start, end).alias("event_timestamp"), numbered("/page_", "page", 100).alias("page_url"),
        numbered("element_", "element", 1000).alias("element_id"), pick(seed, "kind", ELEMENT_TYPES).alias("element_type"),
        numbered("data_", "data", 10000).alias("event_data"),
    )


def fan_out(ids: DataFrame, times: int) -> DataFrame:
    """``times`` consecutive row ids for each id."""
    steps = F.sequence(F.lit(0), F.lit(times - 1))
    return ids.select("i", F.explode(steps).alias("step")).select((F.col("i") * times + F.col("step")).alias("i"))


def gen_all(ids: DataFrame, seed: int = 1) -> dict[str, DataFrame]:
    """All tables for n ids 0..n-1: n customers, products and sessions, 2n
    orders, 3n items, 5n page views and 3n events, with matching keys."""
    n = ids.agg(F.count("*")).scalar()
    users = F.greatest(F.floor(n / 10).cast("bigint"), F.lit(1))
    return {
        "customers": gen_customers(ids, seed), "products": gen_products(ids, seed),
        "orders": gen_orders(fan_out(ids, 2), n, seed), "order_items": gen_order_items(fan_out(ids, 3), n * 2, n, seed),
        "web_sessions": gen_web_sessions(ids, users, seed), "page_views": gen_page_views(fan_out(ids, 5), n, users, seed),
        "user_events": gen_user_events(fan_out(ids, 3), n, users, seed),
    }
