"""The datasets of the warehouse: cleaned tables, marts, metrics, and their refresh."""
