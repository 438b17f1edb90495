from tabmine.functions.text import (char_count, collapse_ws, flag, last_match_int, nan_to_null,
                                   null_above, null_tokens, right_closed_band, strip_ws, word_count)
from tabmine.functions.hashing import hash_int, hash_unit, md5_key

__all__ = ["char_count", "collapse_ws", "flag", "last_match_int", "nan_to_null", "null_above",
           "null_tokens", "right_closed_band", "strip_ws", "word_count", "hash_int", "hash_unit",
           "md5_key"]
