"""Table schemas, labels and other fixed values of the retail data model."""

from __future__ import annotations

# Input schemas (column order and types are the file formats).
TRANSACTIONS = (
    "t_dat STRING, customer_id STRING, article_id BIGINT, price DOUBLE, sales_channel_id INT"
)
CUSTOMERS = (
    "customer_id STRING, FN STRING, Active STRING, club_member_status STRING, "
    "fashion_news_frequency STRING, age DOUBLE, postal_code STRING"
)
ARTICLES = (
    "article_id BIGINT, product_code STRING, prod_name STRING, product_type_no INT, "
    "product_type_name STRING, product_group_name STRING, graphical_appearance_no INT, "
    "graphical_appearance_name STRING, colour_group_code INT, colour_group_name STRING, "
    "perceived_colour_value_id INT, perceived_colour_value_name STRING, "
    "perceived_colour_master_id INT, perceived_colour_master_name STRING, department_no INT, "
    "department_name STRING, index_code STRING, index_name STRING, index_group_no INT, "
    "index_group_name STRING, section_no INT, section_name STRING, garment_group_no INT, "
    "garment_group_name STRING, detail_desc STRING"
)
MESSAGE = TRANSACTIONS
CONTROL = "pipeline_name STRING NOT NULL, last_merged_at TIMESTAMP, last_batch_id BIGINT"

# Age buckets as (exclusive upper bound, label), the open last bucket, and the
# limits outside which the strict mode gives no bucket.
AGE_BUCKETS = [
    (20, "16-19"),
    (25, "20-24"),
    (30, "25-29"),
    (35, "30-34"),
    (40, "35-39"),
    (50, "40-49"),
    (60, "50-59"),
    (70, "60-69"),
]
AGE_LAST = "70+"
AGE_STRICT_LOW, AGE_STRICT_HIGH = 16, 100
AGE_LABELS = [label for _, label in AGE_BUCKETS] + [AGE_LAST]

# Value segments from the lowest to the highest quartile of spend.
SEGMENTS = ["Q1 low", "Q2 mid-low", "Q3 mid-high", "Q4 VIP"]
VIP = SEGMENTS[-1]

# Channel codes.
CHANNELS = {1: "store", 2: "online"}

DEMOGRAPHICS = ["age", "age_group", "club_member_status", "fashion_news_frequency", "postal_code"]
ENRICHMENT_COLUMNS = {"temp_mean", "precipitation", "is_holiday"}

# Model inputs.
BEHAVIOUR = [
    "age",
    "n_transactions",
    "tenure_days",
    "n_distinct_categories",
    "avg_basket_value",
    "purchase_frequency_per_month",
    "recency_days",
]
SPEND_NUMERIC = [
    "age",
    "n_transactions",
    "tenure_days",
    "n_distinct_categories",
    "purchase_frequency_per_month",
    "recency_days",
]
SPEND_CATEGORICAL = ["club_member_status", "fashion_news_frequency", "age_group"]

# Readable names for the technical column names that reach a report.
READABLE = {
    "revenue_share_pct": "share of total revenue (%)",
    "avg_spend": "average spend",
    "avg_purchases": "average number of purchases",
    "n_customers": "number of customers",
    "value_segment": "value segment",
    "segment_revenue": "segment revenue",
    "avg_revenue": "average revenue",
    "age_group": "age group",
}
