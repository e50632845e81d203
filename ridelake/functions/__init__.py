"""Column helpers: text, time, numbers, business rules and null-aware ordering."""
