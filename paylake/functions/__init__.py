"""Column-expression helpers (all JVM-side, codegen-friendly)."""
from paylake.functions.text import (clean_code, month_name_padded, day_name_padded,  # noqa: F401
                                    pg_initcap, surrogate_key)
from paylake.functions.keys import latest_columns, latest_per_key, unknown_member  # noqa: F401
