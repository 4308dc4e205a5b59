"""Rule tables: data the operators are driven by."""
