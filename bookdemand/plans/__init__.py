"""Named query plans over the warehouse tables, and plan inspection helpers."""
