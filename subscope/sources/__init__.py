"""Tables in, tables out, and generated data."""
