from .amounts import convert_amount, currency_scale, signed_amount, to_int, zero_to_null
from .codes import map_company, security_key
from .dates import due_date, parse_yyyymmdd
from .text import (blank_to_null, differs, not_blank, not_empty, not_of_length, strip_zeros,
                   strip_zeros_regex)

__all__ = ["blank_to_null", "convert_amount", "currency_scale", "differs", "due_date",
           "map_company", "not_blank", "not_empty", "not_of_length", "parse_yyyymmdd",
           "security_key", "signed_amount", "strip_zeros", "strip_zeros_regex", "to_int",
           "zero_to_null"]
