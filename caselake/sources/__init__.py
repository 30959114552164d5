"""Reading staged periods, reference files and CSV drops; planning and auditing extracts."""
