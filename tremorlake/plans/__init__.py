"""Query registry: derived inputs, registered queries and their SQL counterparts."""
