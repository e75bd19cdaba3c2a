"""Small functions from columns to columns; all of them stay inside Catalyst."""
