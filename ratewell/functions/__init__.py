"""Row-local column expressions. All are built-in functions inside whole-stage codegen."""
