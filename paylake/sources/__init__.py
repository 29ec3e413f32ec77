"""Sources: driver tables, the payment-schema adapter, raw zone, connectors."""
