"""Request query strings. Hosts and credentials are never part of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delivery-report mask of a message request, retry fields of a call request.
DLR_MASK = 31
CALL_FIELDS = "MaxRetries=3&RetryTime=1&WaitTime=1"


def form_encode(text: Column) -> Column:
    """Form encoding: blank to ``+``, and all but letters, digits, ``-``, ``_``, ``.`` to ``%XX``."""
    return F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A"))


def sms_query(sender: Column, to: Column, text: Column, dlr_mask: int = DLR_MASK) -> Column:
    return F.concat(
        F.lit("from="),
        form_encode(sender),
        F.lit("&to="),
        form_encode(to),
        F.lit("&text="),
        form_encode(text),
        F.lit(f"&dlr-mask={dlr_mask}"),
    )


def voice_query(msisdn: Column, account: int | str) -> Column:
    """Plain interpolation, no encoding."""
    return F.concat(F.lit("msisdn="), msisdn, F.lit(f"&account={account}&{CALL_FIELDS}"))
