"""End-to-end plans: derived feeds, warehouse build, batch runs, maintenance, registry."""
