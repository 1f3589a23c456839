"""Column expressions. Every function takes and returns a ``Column``."""

from muster.functions.encoding import form_encode, sms_query, voice_query
from muster.functions.names import base_name, extension, file_type, has_csv_extension, plain_path
from muster.functions.numbers import is_numeric_string, numeric_value, whole_div
from muster.functions.text import clean_msisdn, is_msisdn, strip_quotes
from muster.functions.times import duration_hundredths, hms, local_time, rate_hundredths

__all__ = [
    "base_name",
    "clean_msisdn",
    "duration_hundredths",
    "extension",
    "file_type",
    "form_encode",
    "has_csv_extension",
    "hms",
    "is_msisdn",
    "is_numeric_string",
    "local_time",
    "numeric_value",
    "plain_path",
    "rate_hundredths",
    "sms_query",
    "strip_quotes",
    "voice_query",
    "whole_div",
]
