"""Column functions (built-in expressions) and the few Python-side helpers."""
