"""Reading and writing: lake folders, response pages, file manifests and warehouse tables."""
