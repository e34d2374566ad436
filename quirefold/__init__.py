"""quirefold: document-structure analytics and corpus preparation on Spark."""
