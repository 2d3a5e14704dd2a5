"""Reading and writing: global tables, raw rows, keys, fragments, layouts."""
