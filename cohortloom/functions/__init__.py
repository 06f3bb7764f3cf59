"""Column expressions: text helpers and field normalizers."""
