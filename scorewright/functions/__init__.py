from scorewright.functions.scalar import (  # noqa: F401
    blank_to_null,
    decision_text,
    dot,
    file_extension,
    has_nonzero,
    keyed_fraction,
    parent_dir,
    percent,
    sigmoid,
    to_double_array,
    trimmed_blank_to_null,
)
