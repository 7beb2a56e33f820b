"""Reading topics, feeds, pages and the store, and writing to them."""
