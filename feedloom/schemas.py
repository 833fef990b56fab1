"""Schemas of the records."""

from __future__ import annotations

from pyspark.sql import types as T

_s, _b = T.StringType(), T.BooleanType()
_list = T.ArrayType(_s)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ARTICLE = _struct(
    source=_s, author=_s, title=_s, description=_s, content=_s, url=_s, source_url=_s, x_url=_s, sources=_list, published_at=_s, image_url=_s, topic_unverified=_b, manual=_b, full_content_fetched=_b, summary=_s, category=_s,
    relevance=_s, vc_signal=_s, subject_type=_s, content_type=_s, subject_company=_s,
)
FUNDING_EVENT = _struct(event_date=_s, announced_time=_s, company=_s, summary=_s, stage=_s, raise_amount=_s, valuation=_s, investors=_s, url=_s, sources=_list, discrepancy=_s, _passes=_list)
CRYPTO_DEAL = _struct(date=_s, company=_s, company_url=_s, round=_s, amount_raw=_s, amount_usd=T.DoubleType(), investors=_list, source_url=_s)
CLAIM = _struct(claim_id=_s, subject_ref=_s, claim_text=_s, claim_type=_s, source_ref=_s, materiality=T.DoubleType())
