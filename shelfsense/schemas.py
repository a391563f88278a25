"""Row shapes of the named collections and the collection names themselves."""

from pyspark.sql import types as T

RECS = T.ArrayType(
    T.StructType([T.StructField("rid", T.LongType()), T.StructField("r", T.DoubleType())])
)

PRODUCT = T.StructType(
    [
        T.StructField("productId", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("imageUrl", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)

# ts is always epoch seconds, held as bigint so that millisecond inputs fit before normalising
RATING = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("productId", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)

USER = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("username", T.StringType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("created_ms", T.LongType()),
        T.StructField("prefGenres", T.ArrayType(T.StringType())),
    ]
)

RATE_MORE = T.StructType(
    [T.StructField("productId", T.LongType()), T.StructField("count", T.LongType())]
)

RATE_MORE_RECENTLY = T.StructType(
    [
        T.StructField("yearmonth", T.IntegerType()),
        T.StructField("productId", T.LongType()),
        T.StructField("count", T.LongType()),
    ]
)

AVERAGE = T.StructType(
    [T.StructField("productId", T.LongType()), T.StructField("avg", T.DoubleType())]
)

PRODUCT_RECS = T.StructType(
    [T.StructField("productId", T.LongType()), T.StructField("recs", RECS)]
)

USER_RECS = T.StructType([T.StructField("userId", T.LongType()), T.StructField("recs", RECS)])

STREAM_RECS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField(
            "recs",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("productId", T.LongType()),
                        T.StructField("score", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)

RECENT_RATINGS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField(
            "recent",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("productId", T.LongType()),
                        T.StructField("score", T.DoubleType()),
                        T.StructField("ts", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

# Collection names shared with the serving side.
PRODUCTS_COLLECTION = "Products"
RATING_COLLECTION = "Rating"
USER_COLLECTION = "User"
RATE_MORE_COLLECTION = "RateMoreProducts"
RATE_MORE_RECENTLY_COLLECTION = "RateMoreRecentlyProducts"
AVERAGE_COLLECTION = "AverageProducts"
ITEMCF_COLLECTION = "ItemCFProductRecs"
CONTENT_COLLECTION = "ContentBasedProductRecs"
USER_RECS_COLLECTION = "UserRecs"
FACTOR_RECS_COLLECTION = "OffLineProductRecs"
STREAM_RECS_COLLECTION = "StreamRecs"

COLLECTION_SCHEMAS = {
    PRODUCTS_COLLECTION: PRODUCT,
    RATING_COLLECTION: RATING,
    USER_COLLECTION: USER,
    RATE_MORE_COLLECTION: RATE_MORE,
    RATE_MORE_RECENTLY_COLLECTION: RATE_MORE_RECENTLY,
    AVERAGE_COLLECTION: AVERAGE,
    ITEMCF_COLLECTION: PRODUCT_RECS,
    CONTENT_COLLECTION: PRODUCT_RECS,
    USER_RECS_COLLECTION: USER_RECS,
    FACTOR_RECS_COLLECTION: PRODUCT_RECS,
    STREAM_RECS_COLLECTION: STREAM_RECS,
}

# partial statistics of ratings, which add up over batches
STATISTICS = T.StructType(
    [
        T.StructField("yearmonth", T.IntegerType()),
        T.StructField("productId", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("n_scores", T.LongType()),
        T.StructField("total", T.DoubleType()),
    ]
)
