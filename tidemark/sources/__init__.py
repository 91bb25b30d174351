"""Reading raw landings and external tables; writing and publishing tables."""
