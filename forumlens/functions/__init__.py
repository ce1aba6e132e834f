"""Column-expression builders: pure functions from Columns to Columns.

Everything here is built-in Catalyst expressions, evaluated in the JVM
(higher-order functions such as ``filter`` run outside generated code);
nothing calls back into Python per row.
"""

from forumlens.functions.tags import (clean_tags, tag_array, tag_list,
                                      has_tag, mentions_tag)
from forumlens.functions.text import (java_trim, strip_markup, post_text,
                                      tokenize_expr)
from forumlens.functions.hashing import md5_bucket, md5_unit

__all__ = ["clean_tags", "tag_array", "tag_list", "has_tag", "mentions_tag",
           "java_trim", "strip_markup", "post_text", "tokenize_expr",
           "md5_bucket", "md5_unit"]
