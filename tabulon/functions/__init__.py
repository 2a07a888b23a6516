"""Column-expression helpers. Everything here builds a ``Column`` that stays
inside Catalyst / whole-stage codegen; nothing runs per row in Python."""
