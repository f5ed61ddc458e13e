"""Writers: lake folders, warehouse tables, item store, publishing."""
