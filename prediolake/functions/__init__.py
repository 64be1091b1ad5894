"""Column expressions: text helpers, normalizers, validation rules and formats."""
