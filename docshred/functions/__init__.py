from docshred.functions.json_fields import array_len, has_key, key_fallback, raw_array_len, zip_arrays

__all__ = ["array_len", "has_key", "key_fallback", "raw_array_len", "zip_arrays"]
