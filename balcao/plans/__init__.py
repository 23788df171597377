"""Table jobs: cleaned tables, marts, audit questions, generated data, whole runs."""
