"""Column types shared by the stages."""

# One answer of the completion client, per prompt.
ANSWER = "struct<raw_response:string,attempts:int,error_class:string,waited:double>"

# A stored response: what (review_key, chunk_idx) was answered.
RESPONSE_FIELDS = "raw_response string, attempts int, error_class string, waited double"

# Fields read from one product page; specs holds whatever rows the page's
# specification table has, as they stand there.
PAGE_FIELDS = (
    "struct<title:string,star:string,price:string,availability:string,"
    "description:string,specs:array<struct<name:string,value:string>>>"
)

# Columns of the flat export, in file order.
EXPORT_COLUMNS = (
    "review_id",
    "product_title",
    "author",
    "rating",
    "date",
    "original_review",
    "cleaned_review",
    "token_count",
    "chunk_count",
    "sentiment",
    "confidence",
    "key_points",
    "llm_summary",
    "source_url",
)
