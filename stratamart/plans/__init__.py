"""The tables: sales and contacts, two station sources, six dimensions and two facts."""
