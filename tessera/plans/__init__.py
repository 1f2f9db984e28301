"""Session set-up, derived test inputs and the query registry."""
