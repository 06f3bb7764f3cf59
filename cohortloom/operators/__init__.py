"""Table operators: crosswalks, audits, rules, duplicates and validation."""
