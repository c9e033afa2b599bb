from tractlake.functions.columns import (  # noqa: F401
    pad_left_keep, last_chars, part_from_end, blank_to_null, zero_pad_int,
    batch_folder, batch_date, file_suffix, base_name, date_after,
)
