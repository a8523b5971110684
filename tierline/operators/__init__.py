"""Pipeline steps as DataFrame operators."""
