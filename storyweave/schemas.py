"""Declared schemas of every table; nothing is inferred."""

from pyspark.sql import types as T

_S, _I, _L, _D, _B, _TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


SELECTOR = _struct(name=_S, id=_S, class_=_S, attrs=T.MapType(_S, _S), regex=_B)
SELECTORS = T.ArrayType(SELECTOR)

SOURCE = _struct(id=_I, name=_S, url=_S)
BIAS = _struct(source_id=_I, type=_S, value=_S)
ACCURACY = _struct(source_id=_I, type=_S, value=_S)
RSSFEED = _struct(id=_S, source_id=_I, url=_S, parser_config=SELECTORS, is_okay=_B)
ARTICLE = _struct(id=_S, rss_feed_id=_S, source_id=_I, url=_S, summary=_S, title=_S, authors=_S,
                  published_at=_TS, added_at=_TS)
RAWCONTENT = _struct(article_id=_S, content=_S, added_at=_TS)
PARSEDCONTENT = _struct(article_id=_S, content=_S, added_at=_TS)
TERMCOUNT = _struct(article_id=_S, term=_S, count=_L, added_at=_TS)
CLUSTER = _struct(id=_S, type=_S, parameters=_S, begin=_TS, end=_TS, added_at=_TS)
CLUSTER_LINK = _struct(cluster_id=_S, article_id=_S)
CLUSTER_KEYWORD = _struct(cluster_id=_S, term=_S, weight=_D)
SEARCH_LOG = _struct(timestamp=_TS, status_code=_I, target_url=_S, client_id=_S, referer=_S, response_count=_L)

# What a registry file holds; parser_config is kept as JSON text until it is normalised.
REGISTRY = {
    "source": SOURCE,
    "rssfeed": _struct(source_id=_I, url=_S, parser_config=_S),
    "bias": BIAS,
    "accuracy": ACCURACY,
}
