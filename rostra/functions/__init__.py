"""Column functions shared by staging, identity resolution and marts."""
